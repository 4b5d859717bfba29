"""Summarise the executed (final AQE) plan of every named view.

Usage: python -m checks.plan_summary [staged_inputs_dir | sf_dir]
Prints a markdown table from the ``formatted`` explain of each executed view:
shuffle exchanges, reused exchanges, broadcast and sort-merge joins (main
query, then its subqueries), and the columns its file scans read.
"""

from __future__ import annotations

import os
import re
import sys

from tillroll import catalog
from tillroll.session import build_session


def _tree(block: str) -> str:
    """The operator tree of one plan block, final AQE plan only."""
    tree = block.split("\n\n(1)")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return tree


def _counts(tree: str) -> tuple[int, int, int, int, int]:
    names = []
    for line in tree.splitlines():
        body = line.lstrip(" :+-*")
        if body and re.search(r"\(\d+\)\s*$", body):
            names.append(body.split()[0])
    return (names.count("Exchange"), names.count("ReusedExchange"),
            names.count("BroadcastHashJoin"), names.count("SortMergeJoin"),
            names.count("ShuffledHashJoin"))


def summarise(formatted: str) -> dict:
    main_part, _, subs = formatted.partition("===== Subqueries =====")
    m = _counts(_tree(main_part))
    sub_blocks = [b for b in re.split(r"\nSubquery:\d+ ", subs) if b.strip()]
    s = [0, 0, 0, 0, 0]
    for b in sub_blocks:
        if "ReusedSubquery" in b.split("\n")[0]:
            continue
        for i, v in enumerate(_counts(_tree(b.split("\n", 1)[1] if "\n" in b else b))):
            s[i] += v
    scans = sorted(set(x for x in re.findall(r"ReadSchema: (struct<.*)", formatted) if x))
    return {"main": m, "sub": tuple(s), "n_sub": len(sub_blocks), "skew": "skew=true" in formatted,
            "scans": scans}


def main(argv) -> None:
    src = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    inputs = (catalog.StagedInputs(spark, src) if os.path.exists(os.path.join(src, "lines"))
              else catalog.TestDataInputs(spark, src))
    print("| view | shuffles (main + subqueries) | reused exchanges | broadcast / sort-merge / "
          "shuffled-hash joins | scan columns |")
    print("| --- | --- | --- | --- | --- |")
    for name, view in catalog.VIEWS.items():
        df = view(inputs)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        s = summarise(qe.explainString(mode))
        (sh, ru, bhj, smj, shj), (ssh, sru, sbhj, ssmj, sshj) = s["main"], s["sub"]
        scans = "; ".join(x.replace("struct<", "").rstrip(">") for x in s["scans"])
        print(f"| {name} | {sh} + {ssh} | {ru + sru} | {bhj + sbhj} / {smj + ssmj} / {shj + sshj}"
              f"{' (skew split)' if s['skew'] else ''} | {scans} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
