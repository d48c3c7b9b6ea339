"""Cross-tokenizer alignment against both public libraries, occurrence by occurrence."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flightlake.llm import align, bpe, queries
from flightlake.llm.common import table
from rows import documents

A = str(public_tokenizers.path("byte_bpe_50k.json"))
B = str(public_tokenizers.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Token occurrences of whole texts, all pairs compared by their byte ranges."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte = {c: b for b, c in enumerate(bpe.byte_characters())}

    def spans(self, text):
        if not text:
            return None
        a = self.a.encode(f" {text}", add_special_tokens=False)
        raw_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a.ids]
        b = self.b.encode(text)
        raw_b = []
        for i in b:
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            raw_b.append(bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode())
        want = f" {text}".encode()
        if b"".join(raw_a) != want or b"".join(raw_b) != want:
            return None
        out = []
        for ids, raw in ((a.ids, raw_a), (b, raw_b)):
            at, spans = 0, []
            for i, r in zip(ids, raw, strict=True):
                spans.append((i, at, at + len(r)))
                at += len(r)
            out.append(spans)
        return out

    def links(self, text):
        """(groups, linked id pairs with repeats) or None."""
        found = self.spans(text)
        if found is None:
            return None
        a, b = found
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, links, start = [], [], 0
        for cut in cuts:
            mine = [[t for t in side if start <= t[1] and t[2] <= cut] for side in (a, b)]
            groups.append(tuple([t[0] for t in side] for side in mine))
            links += [(x[0], y[0]) for x in mine[0] for y in mine[1] if x[1] < y[2] and y[1] < x[2]]
            start = cut
        return groups, links

    def table(self, texts):
        found = [self.links(t) for t in texts]
        documents = Counter(pair for f in found if f for pair in set(f[1]))
        most = {}
        for (a, _), n in documents.items():
            most[a] = max(most.get(a, 0), n)
        for f in found:
            if f is None:
                yield (0, 0, 0, 0, 0, 0, "")
                continue
            groups, links = f
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            yield (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(documents[p] == most[p[0]] for p in links),
                sum(documents[p] for p in links),
                hashlib.sha256(shown.encode()).hexdigest(),
            )


@pytest.fixture(scope="module")
def plain():
    return Plain()


TEXTS = [
    None,
    "",
    " ",
    "one two three",
    "one two three",
    "tokenization of unbelievable antidisestablishmentarianism, naïve café",
    "  leading\n\nlines \t and  \xa0 spaces　 ",
    "中文 and 🙂🙂 emoji, \x00 nul \x1c",
    "a ▁ mark that is not given back",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "don't we'll they've 2024 1,000.50 x_y",
    "q" * 300 + " " + "=" * 100,
    "ends with a space ",
    "x \n y  ",
]


def check(spark, plain, texts, **options):
    docs = documents(spark, texts)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.align(docs, A, B, **options).collect()}
    assert got == dict(enumerate(plain.table(texts)))


def test_odd_texts(spark, plain):
    check(spark, plain, TEXTS)


def test_small_blocks_slices_and_memory(spark, plain, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_BYTES", 200)
    monkeypatch.setattr(align, "SHARD_PAIRS", 50)
    docs = [r.text for r in table(spark, SF, "documents").limit(60).collect()]
    check(spark, plain, [*TEXTS, *docs])


def test_long_text_in_slices(plain, monkeypatch):
    monkeypatch.setattr(align, "SLICE", 50)
    monkeypatch.setattr(bpe, "SLICE", 50)
    monkeypatch.setattr(align, "REMEMBERED", 8)
    with open(B, "rb") as file:
        aligner = align.Aligner(bpe.Vocabulary(A), file.read())
    texts = ["the quick brown fox jumps over the lazy dog, " * 40, "short one", "a ▁ b " * 50]
    for text, (totals, digest, pairs, times) in zip(texts, aligner.read(texts), strict=True):
        groups_and_links = plain.links(text)
        want = next(iter(plain.table([text])))
        assert (*totals, digest) == (*want[:4], want[6])
        links = Counter(groups_and_links[1]) if groups_and_links else {}
        assert {divmod(p, aligner.size_b): t for p, t in zip(pairs.tolist(), times.tolist(), strict=True)} == links


def test_whole_texts_where_pieces_cross_words(plain):
    with open(B, "rb") as file:
        aligner = align.Aligner(bpe.Vocabulary(A), file.read())
    assert not aligner.whole
    aligner.whole = True
    want = [(*row[:4], row[6]) for row in plain.table(TEXTS)]
    got = [(*totals, digest) for totals, digest, _, _ in aligner.read([t or "" for t in TEXTS])]
    assert got == want


def test_bitmaps_count_documents_and_links():
    import numpy as np

    rng = np.random.default_rng(3)
    times = rng.integers(0, 12, (5, 200))
    pairs, docs = np.nonzero(times)
    planes = align.planes_of(pairs, docs, times[pairs, docs], 4)
    assert align._document_counts(planes, 5).tolist() == (times > 0).sum(axis=1).tolist()
    assert align._link_counts(planes, 5).tolist() == times.sum(axis=1).tolist()
    back = np.zeros_like(times)
    for k, plane in enumerate(planes):
        again = align.Bitmaps.unpack(*plane.pack(), 4)
        for pair, doc in again.members():
            back[pair, doc] += 1 << k
    assert (back == times).all()


def test_pair_counts(spark, plain):
    texts = [*TEXTS, "one one one two"]
    found = [f[1] for f in map(plain.links, texts) if f]
    links = Counter(p for f in found for p in f)
    held = Counter(p for f in found for p in set(f))
    got = align.pair_counts(documents(spark, texts), A, B).collect()
    assert {(r.a_id, r.b_id): (r.documents, r.links) for r in got} == {p: (held[p], links[p]) for p in links}


def test_no_rows_and_clashing_columns(spark, plain):
    assert align.align(documents(spark, []), A, B).count() == 0
    docs = documents(spark, ["one two", None], lang=["x", "y"]).withColumnsRenamed({"lang": "block", "source": "N_A"})
    rows = align.align(docs, A, B)
    assert rows.columns == ["doc_id", "text", "block", "n_chars", *COLUMNS]
    assert {r.block: r.n_a for r in rows.collect()} == {"x": 2, "y": 0}


def test_query(spark, plain):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    want = dict(zip(texts, plain.table(texts.values()), strict=True))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_alignment(spark, SF).collect()}
    assert got == want
