"""Print per-stage durations from a Spark event log folder (zstd or plain)."""

import collections
import glob
import io
import json
import sys

import zstandard


def lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8", "replace").splitlines()


def main(folder, last=30):
    stages, tasks = {}, collections.defaultdict(list)
    for f in sorted(glob.glob(folder + "/**/*", recursive=True)):
        if "events_" not in f and not f.endswith(".zstd"):
            continue
        for line in lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:50], si["Number of Tasks"],
                                          si["Completion Time"] - si["Submission Time"])
            elif e["Event"] == "SparkListenerTaskEnd":
                tm = e.get("Task Metrics") or {}
                tasks[e["Stage ID"]].append((tm.get("Executor Run Time", 0), tm.get("Executor CPU Time", 0) / 1e6))
    for k in sorted(stages)[-last:]:
        t = tasks[k]
        print(k, stages[k], "sum run ms", sum(x[0] for x in t), "max run", max((x[0] for x in t), default=0))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 30)
