"""Compare every registered query with its SQL: ``python tests/check_oracle.py [dir] [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from parcelion.session import local_session  # noqa: E402
from tests.harness import compare, connect  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session()
spark.sparkContext.setLogLevel("ERROR")
con, sqls, bad, total = connect(sf_dir), oracle_sql(), 0, time.time()
for name, query in queries().items():
    if len(sys.argv) > 2 and name not in sys.argv[2:]:
        continue
    begun = time.time()
    try:
        if name in sqls:
            found = compare(spark, con, sf_dir, query, sqls[name])
        else:
            result = query(spark, sf_dir).collect()
            found = "" if result else "no rows"
            print("   ", result[:3])
    except Exception as error:  # noqa: BLE001
        found = f"{type(error).__name__}: {str(error)[:700]}"
    bad += bool(found)
    kind = "sql" if name in sqls else "rows"
    print(f"{'BAD ' if found else 'ok  '} {name} [{kind}] {time.time() - begun:.1f}s {found}", flush=True)
print(f"{bad} bad, {time.time() - total:.0f}s")
