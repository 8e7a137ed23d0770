"""Run every registered query (or those named) against its SQL twin; print a line each."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parents[1] / "tests")]

from oracle import compare  # noqa: E402

from registry import QUERIES, SQL  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        began = time.perf_counter()
        try:
            if name in SQL:
                rows, wrong, inexact = compare(spark, QUERIES[name], SQL[name], sf_dir)
            else:
                rows, wrong, inexact = QUERIES[name](spark, sf_dir).count(), None, 0
        except Exception as error:  # report and go on
            rows, wrong, inexact = -1, f"{type(error).__name__}: {str(error)[:600]}", 0
        bad += wrong is not None
        note = wrong or ("ok" if not inexact else f"ok, {inexact} rows differ in the last place")
        print(f"{name:32} {rows:8} {time.perf_counter() - began:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} wrong")


main()
