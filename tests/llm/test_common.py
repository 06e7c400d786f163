from types import SimpleNamespace

import pyarrow as pa

from paceforge.llm import common


def session(master, app, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: conf.get(k.replace(".", "_"), *d)), sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_shared_folder():
    named = session("local[2]", "a", spark_checkpoint_dir="hdfs://x/y/")
    assert common.shared_folder(named) == "hdfs://x/y"
    alone = session("local[2]", "b")
    assert common.shared_folder(alone) == common.shared_folder(alone) != common.shared_folder(session("local", "c"))
    cluster = session("local-cluster[3,2,1000]", "d", spark_sql_warehouse_dir="s3://w")
    assert common.shared_folder(cluster) == "s3://w/paceforge-llm"


def test_chunks_keep_all_rows(monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 500, 3, 4, 5, 900, 1)])], ["t"])
    pieces = list(common.chunks(iter([batch, batch.slice(0, 0)])))
    assert [t for p in pieces for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(p.num_rows for p in pieces) == 1


def test_stored_reads_back(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as t", "array(id) as a")
    again = common.stored(df)
    assert again.schema == df.schema or again.dtypes == df.dtypes
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
