"""Command line: one pipeline run, or a run-to-completion file stream.

    python -m verdant run --grid LANDING --table FACT --state HWM [--full]
                          [--run-log LOG] [--rejects REJ] [--overlap '1 hour']
                          [--max-future '1 day'] [--formats ISO 'd.M.yyyy H:mm' ...]
                          [--multi-line] [--parse-partitions N] [--preview N]
                          [--changed-only ['1 hour']] [--marks MARKS] [--matrix] [--vote]
                          [--keep-unmapped]
    python -m verdant compact [--table FACT] [--state HWM] [--marks MARKS] [--run-log LOG]
    python -m verdant replay --table FACT --rejects REJ --formats ISO 'd.M.yyyy H:mm' ...
    python -m verdant stream --grid LANDING --table FACT [--checkpoint CKPT]
                             [--max-files N] [--state HWM] [--run-log LOG]
                             [--rejects REJ] [--formats ...]

Both take --cluster: the settings profile for a large cluster.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
import time


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="verdant")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="one incremental (or --full) run")
    r.add_argument("--grid", required=True, help="folder of CSV grids")
    r.add_argument("--table", required=True, help="fact table path")
    r.add_argument("--state", required=True, help="high-water-mark table path")
    r.add_argument("--run-log")
    r.add_argument("--rejects")
    r.add_argument("--full", action="store_true", help="ignore the stored mark")
    r.add_argument("--overlap", help="re-read this interval before the mark")
    r.add_argument("--max-future", help="reject rows later than now + interval")
    r.add_argument("--multi-line", action="store_true", help="quoted cells may hold line breaks (a file is one task)")
    r.add_argument("--parse-partitions", type=int, help="deal rows over N tasks before parsing (few large files)")
    r.add_argument("--preview", type=int, default=0, help="show N stored rows at the end")
    r.add_argument("--changed-only", nargs="?", const="1 hour", metavar="OVERLAP",
                   help="open only files changed since the last successful run in --run-log, less this interval")
    r.add_argument("--marks", help="table of a mark per plant, used in place of the single mark")
    r.add_argument("--vote", action="store_true", help="settle day-first or month-first dates by each file's own values")
    r.add_argument("--matrix", action="store_true", help="the grids are JSON matrices of values")
    c = sub.add_parser("compact", help="pack many small files into few, with the same rows")
    c.add_argument("--table", help="fact table path")
    c.add_argument("--state")
    c.add_argument("--marks")
    c.add_argument("--run-log")
    c.add_argument("--at-least", type=int, default=4, help="files a day from which on it is rewritten")
    rp = sub.add_parser("replay", help="parse refused rows again, with further layouts")
    rp.add_argument("--table", required=True)
    rp.add_argument("--rejects", required=True)
    for p in (r, rp):
        p.add_argument("--keep-unmapped", action="store_true",
                       help="store cells under unknown headers with their row")
    s = sub.add_parser("stream", help="consume new grid files, then stop")
    s.add_argument("--grid", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--checkpoint")
    s.add_argument("--state", help="high-water-mark table to keep in step")
    s.add_argument("--max-files", type=int)
    s.add_argument("--run-log")
    s.add_argument("--rejects")
    for p in (r, rp, s):
        p.add_argument("--formats", nargs="+", help="timestamp layouts, tried in order (ISO: the year-first family)")
    for p in (r, rp, s, c):
        p.add_argument("--cluster", action="store_true", help="settings profile for a large cluster")
    a = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    from . import contract as K
    from .session import build_session
    spark = build_session(cluster=a.cluster)
    formats = getattr(a, "formats", None) or K.TIMESTAMP_FORMATS
    started = time.monotonic()
    if a.cmd == "run":
        from .operators.upsert import read_table
        from .plans.pipeline import changed_since, run
        from .plans.views import preview
        from .sources.grid import read_grid
        from .sources.matrix import read_matrix
        if a.changed_only and not a.run_log:
            ap.error("--changed-only needs --run-log, which knows the last run")
        after = changed_since(spark, a.run_log, overlap=a.changed_only) if a.changed_only and not a.full else None
        grid = (read_matrix(spark, a.grid, modified_after=after) if a.matrix
                else read_grid(spark, a.grid, modified_after=after, multi_line=a.multi_line))
        if a.vote:
            from .operators.layouts import file_of, settle
            grid, formats = settle(grid, file_of(grid)), a.formats or [K.ISO]
        res = run(spark, grid, a.table, a.state, run_log_path=a.run_log,
                  rejects_path=a.rejects, full=a.full, overlap=a.overlap,
                  max_future=a.max_future, formats=formats, parse_partitions=a.parse_partitions, marks_path=a.marks,
                  keep_unmapped=a.keep_unmapped)
        out = {k: str(v) for k, v in vars(res).items()}
        if a.preview and (fact := read_table(spark, a.table)) is not None:
            out["preview"] = [r.asDict() for r in preview(fact, a.preview).collect()]
    elif a.cmd == "replay":
        from .plans.replay import replay
        out = vars(replay(spark, a.rejects, a.table, formats, keep_unmapped=a.keep_unmapped))
    elif a.cmd == "compact":
        from .operators.compact import compact_days, compact_log
        out = {"days": compact_days(spark, a.table, a.at_least)} if a.table else {}
        for path, schema in ((a.state, K.STATE_SCHEMA), (a.marks, K.MARKS_SCHEMA), (a.run_log, K.RUN_LOG_SCHEMA)):
            if path:
                out[path] = compact_log(spark, path, schema)
    else:
        from .streaming.ingest import ingest_available
        ingest_available(spark, a.grid, a.table, checkpoint=a.checkpoint, formats=formats,
                         max_files_per_trigger=a.max_files, state_path=a.state,
                         rejects_path=a.rejects, run_log_path=a.run_log)
        out = {}
    print(json.dumps({**out, "seconds": round(time.monotonic() - started, 1)}, default=str))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
