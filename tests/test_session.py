"""Session settings: what was submitted wins, the rest is filled in."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
from flightlake import session
spark = session.build_session("t", master="local[2]"{more})
print("FOUND", *[spark.conf.get(k, None) for k in {keys!r}])
spark.stop()
"""


def settings(keys, submitted=(), more=""):
    """Settings of a session built in a process of its own, with what spark-submit was given."""
    flags = " ".join(f"--conf {s}" for s in submitted)
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": f"{flags} pyspark-shell"}
    run = subprocess.run(
        [sys.executable, "-c", CODE.format(keys=keys, more=more)],
        cwd=ROOT,
        env=env,
        capture_output=True,
        text=True,
        timeout=180,
        check=True,
    )
    return next(x for x in run.stdout.splitlines() if x.startswith("FOUND")).split()[1:]


ANSI = "spark.sql.ansi.enabled"
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_submitted_settings_win():
    submitted = [f"{ANSI}=false", f"{COALESCE}=false", f"{INITIAL}=77"]
    assert settings([ANSI, COALESCE, INITIAL], submitted) == ["false", "false", "77"]


def test_defaults_fill_the_rest():
    keys = [ANSI, COALESCE, INITIAL, "spark.sql.session.timeZone", "spark.ui.enabled"]
    assert settings(keys) == ["true", "true", "200", "UTC", "false"]


def test_given_shuffle_partitions_are_left_alone():
    given = ', **{"spark.sql.shuffle.partitions": "5"}'
    assert settings(["spark.sql.shuffle.partitions", INITIAL], more=given) == ["5", "None"]
