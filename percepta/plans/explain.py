"""Summarize the physical plan of every catalogue query.

``python -m percepta.plans.explain [--sf DIR] [--out PLANS.md]`` builds each
query (fits run as they do in the query) and records, from
``explain("formatted")`` of the returned frame (static plan, AQE off):
shuffles (``Exchange``), broadcasts, sorts, the columns each scan reads and
its pushed filters, and the number of whole-stage-codegen stages.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    head = text.split("\n\n\n", 1)[0]
    reads = re.findall(r"ReadSchema: struct<(.*)>", text)
    pushed = [p for p in re.findall(r"PushedFilters: \[(.*)\]", text) if p]
    return {
        "exchanges": len(re.findall(r"\bExchange\b", head)),
        "broadcasts": len(re.findall(r"BroadcastExchange", head)),
        "sorts": len(re.findall(r"\bSort \(", head)),
        "codegen_stages": len(set(re.findall(r"codegen id : (\d+)", text))),
        "scans": len(re.findall(r"Scan (?:parquet|csv)", head)),
        "read_columns": sorted({c.split(":")[0] for r in reads for c in r.split(",")}),
        "pushed_filters": pushed,
        "top_k": "TakeOrderedAndProject" in head,
    }


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--out", default=None)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args(argv)

    from percepta.plans.catalog import QUERIES
    from percepta.session import build_session

    spark = build_session("local[8]")
    # Static plans: with AQE on, codegen stages are only numbered once a plan runs.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    lines = [
        "| query | shuffles | broadcasts | sorts | codegen stages | scans | columns read | pushed filters |",
        "| --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name in args.names or list(QUERIES):
        s = summarize(plan_text(QUERIES[name](spark, args.sf)))
        sorts = "top-k" if s["top_k"] else str(s["sorts"])
        lines.append(
            f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {sorts} | {s['codegen_stages']} | "
            f"{s['scans']} | {', '.join(s['read_columns'])} | {'; '.join(s['pushed_filters']) or '-'} |"
        )
    table = "\n".join(lines)
    if args.out:
        with open(args.out, "w") as fh:
            fh.write(table + "\n")
    print(table)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
