import datetime as dt
import tempfile

from helpers import raw_frame

from ledgerline import fixed
from ledgerline.params import Params
from ledgerline.sources import raw as rw
from ledgerline.streaming.landing import start_landing, start_rejects

P = Params(snapshot_date=dt.date(2024, 12, 31))


def _land(spark, path, ids):
    df = raw_frame(spark, [{"complaint_id": str(i)} for i in ids]).drop("source_snapshot_date")
    rw.write_chunks(df.toDF(*[h for _, h in fixed.RAW_COLUMNS]), path, rows=10, partitions=1)


def test_landing_is_incremental_and_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-stream-")
    landing, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/ckpt"
    _land(spark, f"{landing}/batch1", range(0, 25))
    start_landing(spark, f"{landing}/*", out, ckpt, P, "u", dt.datetime(2025, 1, 1), "run-1").awaitTermination()
    assert spark.read.parquet(out).count() == 25
    _land(spark, f"{landing}/batch2", range(25, 40))
    start_landing(spark, f"{landing}/*", out, ckpt, P, "u", dt.datetime(2025, 1, 1), "run-1").awaitTermination()
    got = [r.complaint_id for r in spark.read.parquet(out).select("complaint_id").collect()]
    assert sorted(got, key=int) == [str(i) for i in range(40)]      # new files only, no duplicates


def test_rejects_have_their_own_sink(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-stream-")
    _land(spark, f"{root}/landing/a", range(5))
    with open(f"{root}/landing/a/bad.csv", "w") as f:
        f.write(",".join(h for _, h in fixed.RAW_COLUMNS) + "\n" + ",".join("x" * 17) + "\n")
    for start, out in ((start_landing, "ok"), (start_rejects, "bad")):
        start(spark, f"{root}/landing/*", f"{root}/{out}", f"{root}/ckpt-{out}", P, "u", dt.datetime(2025, 1, 1), "run-1").awaitTermination()
    bad = spark.read.parquet(f"{root}/bad").collect()
    assert len(bad) == 1 and bad[0].raw_line.startswith("x,") and bad[0].file == "bad.csv" and bad[0].load_run_id == "run-1"
