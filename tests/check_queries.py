"""Prints how every registered query compares: python tests/check_queries.py [part of name] [sf] [max group rows]."""

import sys
import time
import traceback

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

import harness
from driftline.functions import ordered, quantile
from driftline.plans import catalog
from driftline.session import local_session

part = sys.argv[1] if len(sys.argv) > 1 else ""
sf = sys.argv[2] if len(sys.argv) > 2 else "0.01"
if len(sys.argv) > 3:
    ordered.MAX_GROUP_ROWS = quantile.MAX_GROUP_VALUES = int(sys.argv[3])
spark = local_session(8)
path = f"/root/testdata/sf{sf}"
con = harness.oracle(path)
bad = 0
for name, fn in catalog.QUERIES.items():
    if not any(name.startswith(p) for p in part.split(",")):
        continue
    start = time.time()
    try:
        if name in catalog.ORACLES:
            said = harness.compare(fn(spark, path), con, catalog.ORACLES[name])
        else:
            said = None
            print("   rows only:", fn(spark, path).count())
    except Exception as err:  # noqa: BLE001
        said = "".join(traceback.format_exception_only(err))[:1500]
        tb = traceback.extract_tb(err.__traceback__)
        said += str([f"{f.filename.split('/')[-1]}:{f.lineno}" for f in tb if "driftline" in f.filename])
    bad += said is not None
    print(f"{'ok ' if said is None else 'BAD'} {name} {time.time() - start:.2f}s {said or ''}", flush=True)
print("bad:", bad)
