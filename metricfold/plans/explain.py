"""Write PLANS.md: the physical plan trees of every registered query, with the
numbers of shuffles, scans, sorting aggregates and Python steps.

A query that writes tables or runs streams while it is built leaves most of its
work in plans of its own; these are taken from Spark's event log and listed
before the query's last plan, equal ones (as the micro-batches of a stream)
once, with their number.

Usage: python -m metricfold.plans.explain [sf_dir] [out_file]
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from collections import Counter

START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"


def tree(text: str) -> str:
    """The tree of a formatted plan, without the details and the numbers of its nodes."""
    head = re.split(r"\n\n\(\d+\)", text)[0].replace("== Physical Plan ==", "").strip()
    head = re.split(r"\n *\+- == Initial Plan ==", head)[0]
    return re.sub(r" \(\d+\)|\[codegen id : \d+\]", "", head).rstrip()


def summary(head: str) -> dict[str, int]:
    return {"shuffles": len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange\b", head)),
            "broadcasts": head.count("BroadcastExchange"), "scans": len(re.findall(r"Scan (?:parquet|json|text)", head)),
            "sort aggregates": head.count("SortAggregate"), "Python steps": len(re.findall("Python|Pandas|Arrow|PySpark|recorded_samples|audit_lines", head))}


class Log:
    """Plans that Spark has run since the last look."""

    def __init__(self, folder: str):
        self.folder, self.at = folder, {}

    def new(self) -> list[str]:
        out = []
        for base, _, names in os.walk(self.folder):
            for path in (os.path.join(base, n) for n in names):
                with open(path, errors="replace") as f:
                    f.seek(self.at.get(path, 0))
                    while line := f.readline():
                        if not line.endswith("\n"):
                            break
                        self.at[path] = f.tell()
                        if START in line[:200]:
                            out.append(tree(json.loads(line)["physicalPlanDescription"]))
        return out


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else "PLANS.md"
    sys.path.insert(0, ".")
    from metricfold.plans import catalog
    from metricfold.session import build_session
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("local[8]", 16, app="metricfold-plans", conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file:{folder}", "spark.eventLog.compress": "false"})
    log = Log(folder)
    parts = ["# Physical plans of the registered queries", "",
             f"Input: `{sf_dir}`. Numbers count the last plan and, where a query writes tables or runs streams while it is "
             "built, the plans of those steps (once each). Plans are shown before execution: AQE may still coalesce "
             "partitions, switch a sort-merge join to broadcast from measured sizes, or split skewed partitions.", "",
             "| query | plans run while built | shuffles | broadcasts | scans | sort aggregates | Python steps |",
             "|---|---|---|---|---|---|---|"]
    bodies = []
    for name, fn in sorted(catalog.queries().items()):
        log.new()
        df = fn(spark, sf_dir)
        last = tree(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))
        inner = Counter(log.new())
        total = Counter()
        for head in [*inner, last]:
            total.update(summary(head))
        parts.append(f"| {name} | {sum(inner.values())} | " + " | ".join(str(total[k]) for k in summary("")) + " |")
        bodies += [f"## {name}", ""]
        for head, n in inner.items():
            bodies += [f"Run {n} times while built:" if n > 1 else "Run while built:", "", "```", head, "```", ""]
        bodies += ["```", last, "```", ""]
    with open(out, "w") as f:
        f.write("\n".join(parts + [""] + bodies))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
