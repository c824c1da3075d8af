"""Helper for test_fault_tolerance: build the warehouse twice in one session
with task retries enabled — once clean, once with the first attempt of scan
tasks failing — and print whether every table is identical."""

import dataclasses
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from stardw.params import FIXTURE_PARAMS  # noqa: E402
from stardw.plans.warehouse import Warehouse  # noqa: E402
from stardw.session import build_session  # noqa: E402
from stardw.sources import fixtures as FX  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


def snapshot(w):
    return {t: sorted(tuple(r) for r in df.collect()) for t, df in w.tables().items()}


def main(sf_dir):
    spark = build_session("local[4,3]", app="fault-injection", shuffle_partitions=4)
    raw = FX.fixture_tables(spark, sf_dir)
    clean = snapshot(Warehouse(raw, FIXTURE_PARAMS))
    flaky = dataclasses.replace(
        raw,
        items=raw.items.where(fail_first_attempt(F.col("order_id"))),
        orders=raw.orders.where(fail_first_attempt(F.col("order_id"))),
        customers=raw.customers.where(fail_first_attempt(F.col("customer_id"))))
    retried = snapshot(Warehouse(flaky, FIXTURE_PARAMS))
    same = all(clean[t] == retried[t] for t in clean)
    print("RESULT", "identical" if same else "DIFFERENT", sum(len(v) for v in clean.values()))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
