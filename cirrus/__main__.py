"""Command line: python -m cirrus <load|ask|quality|stream> ...

    load    --stage DIR --root DIR            copy new JSON files, rebuild curated tables
    ask     --root DIR --question q4 --start 2024-03-29 --end 2024-04-02 [--sql]
    quality --root DIR [--flow]               constraint violation counts (curated / consumption tables)
    stream  --root DIR [--once]               run the continuous flow (files in <root>/stage)
"""

from __future__ import annotations

import argparse
import time

from cirrus.plans import warehouse
from cirrus.session import build_session
from cirrus.streaming.flow import ObservationFlow


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cirrus")
    ap.add_argument("command", choices=("load", "ask", "quality", "stream"))
    ap.add_argument("--root", required=True)
    ap.add_argument("--stage")
    ap.add_argument("--question", default="q4")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--sql", action="store_true")
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--flow", action="store_true", help="quality of the stream flow's consumption tables")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    if a.command == "load":
        warehouse.load_history(spark, a.stage, a.root)
    elif a.command == "ask":
        warehouse.ask(spark, a.root, a.question, a.start, a.end, sql=a.sql).show(truncate=False)
    elif a.command == "quality":
        report = ObservationFlow(spark, a.root).data_quality() if a.flow else warehouse.data_quality(spark, a.root)
        report.show(truncate=False)
    else:
        flow = ObservationFlow(spark, a.root)
        if a.once:
            flow.run_once()
        else:
            queries = flow.start()
            while all(q.isActive for q in queries):
                time.sleep(30)


if __name__ == "__main__":
    main()
