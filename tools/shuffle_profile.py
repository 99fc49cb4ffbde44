"""Rows read vs rows shuffled per registered query, from Spark's event log.

Runs every query (noop sink) with the event log written to a scratch folder,
then sums task metrics per query. Prints a markdown table.

    python tools/shuffle_profile.py /root/testdata/sf0.1 /tmp/run-XXXX
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadpulse.plans import registry  # noqa: E402
from roadpulse.session import get_session  # noqa: E402


def main() -> None:
    sf_dir, scratch = sys.argv[1], sys.argv[2]
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs, exist_ok=True)
    spark = get_session("roadpulse-shuffle-profile", master="local[8]", shuffle_partitions=8,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                               "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    names = list(registry.QUERIES)
    for name in names:
        spark.sparkContext.setJobDescription(name)
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_query: dict[int, str] = {}
    totals = {n: {"read": 0, "shuffled": 0, "bytes": 0, "stages": set()} for n in names}
    files = sorted(p for p in glob.glob(os.path.join(logs, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    q = stage_query.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if q not in totals:
                        continue
                    totals[q]["read"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    sw = m.get("Shuffle Write Metrics") or {}
                    totals[q]["shuffled"] += sw.get("Shuffle Records Written", 0)
                    totals[q]["bytes"] += sw.get("Shuffle Bytes Written", 0)
                    totals[q]["stages"].add(ev.get("Stage ID"))
    print("| Query | Rows read | Rows shuffled | Shuffle KB | Shuffled / read |")
    print("|---|---|---|---|---|")
    for n in names:
        t = totals[n]
        ratio = t["shuffled"] / t["read"] if t["read"] else 0.0
        print(f"| `{n}` | {t['read']:,} | {t['shuffled']:,} | {t['bytes'] / 1024:,.0f} | {ratio:.3f} |")


if __name__ == "__main__":
    main()
