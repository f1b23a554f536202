"""The export sink: every line once, whatever fails and comes again."""

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agentaudit.plans import fixtures
from agentaudit.sources import export, otlp, spans as span_files
from agentaudit.streaming import pipeline

from helpers import span, spans


def batch(*lines):
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def read(spark, path):
    return sorted(r.value for r in export.read_lines(spark, str(path)).collect())


def test_a_batch_that_comes_again_is_dropped(spark, tmp_path):
    writer = export.LinesWriter(str(tmp_path))
    for _ in range(2):
        messages = [writer.write(iter([batch("a", None, "b")])), writer.write(iter([])), None, writer.write(iter([batch("é")]))]
        writer.commit(messages, 0)
    assert read(spark, tmp_path) == ["a", "b", "é"]
    assert list((tmp_path / "_pending").iterdir()) == []


def test_an_unfinished_batch_is_replaced(spark, tmp_path):
    writer = export.LinesWriter(str(tmp_path))
    # The driver was lost between putting files in place and the mark.
    writer.commit([writer.write(iter([batch(f"old{i}")])) for i in range(4)], 3)
    (tmp_path / "_done" / "3").unlink()
    assert read(spark, tmp_path) == []
    writer.commit([writer.write(iter([batch("new")]))], 3)
    assert read(spark, tmp_path) == ["new"]


def test_abort_leaves_nothing(spark, tmp_path):
    writer = export.LinesWriter(str(tmp_path))
    writer.abort([writer.write(iter([batch("x")])), None], 0)
    assert read(spark, tmp_path) == [] and list((tmp_path / "_pending").iterdir()) == []


def test_a_failing_stream_writes_each_row_once(spark, tmp_path):
    """A task fails in the middle of a batch; the query ends, starts again and repeats the batch."""
    for part in range(3):
        spark.range(part * 100, part * 100 + 100).select(F.col("id").cast("string").alias("value")).repartition(
            4).write.mode("append").text(f"{tmp_path}/in")
    marker = str(tmp_path / "failed-once")

    @F.udf("string")
    def fragile(value):
        if value == "250" and not Path(marker).exists():
            Path(marker).touch()
            raise RuntimeError("lost")
        return value

    def run():
        stream = spark.readStream.format("text").option("maxFilesPerTrigger", 5).load(f"{tmp_path}/in")
        lines = stream.select(fragile("value").alias("value"))
        return export.export(lines, f"{tmp_path}/out", f"{tmp_path}/ck", lambda w: w.trigger(availableNow=True).start())

    query = run()
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    run().awaitTermination()
    assert read(spark, tmp_path / "out") == sorted(map(str, range(300)))
    assert len(list((tmp_path / "out" / "_done").iterdir())) >= 3


def test_a_lost_mark_in_the_checkpoint(spark, tmp_path):
    """The sink committed but the stream did not note it: the batch comes again and is dropped."""
    spark.range(50).select(F.col("id").cast("string").alias("value")).write.text(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.format("text").load(f"{tmp_path}/in")
        export.export(stream, f"{tmp_path}/out", f"{tmp_path}/ck",
                      lambda w: w.trigger(availableNow=True).start()).awaitTermination()

    run()
    for file in (tmp_path / "ck" / "commits").iterdir():
        file.unlink()
    run()
    assert read(spark, tmp_path / "out") == sorted(map(str, range(50)))


def test_compressed_files_go_on_in_others(spark, tmp_path, monkeypatch):
    """Nothing splits a compressed file among readers, so a task begins another one in time."""
    monkeypatch.setattr(export, "FILE_BYTES", 100)
    want = [f"line {i} é" for i in range(100)] + [""]
    for kind, ending in export.ENDINGS.items():
        writer = export.LinesWriter(str(tmp_path / kind), kind)
        messages = [writer.write(iter([batch(*want[:50]), batch(None), batch(*want[50:80])])),
                    writer.write(iter([batch(line) for line in want[80:]])), writer.write(iter([batch(None)]))]
        writer.commit(messages, 0)
        files = sorted(f.name for f in (tmp_path / kind / "batch=0").iterdir())
        assert files[0] == f"part-00000{ending}" and len(files) > 3
        assert read(spark, tmp_path / kind) == sorted(want)
        assert list((tmp_path / kind / "_pending").iterdir()) == []
        writer.abort([writer.write(iter([batch(*want[:50]), batch(*want[50:])]))], 1)
        assert list((tmp_path / kind / "_pending").iterdir()) == []


def test_unknown_compression_is_refused():
    from pyspark.sql.types import StringType, StructType

    with pytest.raises(ValueError, match="compressions none, gzip"):
        export.LinesExport({"path": "/out", "compression": "lzo"}).streamWriter(StructType().add("value", StringType()), False)


def test_other_columns_are_refused(spark, tmp_path):
    export.register(spark)
    stream = spark.readStream.format("rate").load()
    with pytest.raises(Exception, match="one text column"):
        stream.writeStream.format(export.FORMAT).option("path", str(tmp_path)).option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()


def test_exported_spans_are_redacted(spark, sf, tmp_path):
    fixtures.spans(spark, sf).write.parquet(f"{tmp_path}/spans")
    query = pipeline.export(span_files.stream_spans(spark, f"{tmp_path}/spans"), f"{tmp_path}/out", f"{tmp_path}/ck", once=True)
    query.awaitTermination()
    assert query.exception() is None
    lines = export.read_lines(spark, f"{tmp_path}/out")
    assert lines.count() == fixtures.records(spark, sf).count()
    assert lines.where("value LIKE '%hello from%' OR value LIKE '%u-agent%'").count() == 0
    assert otlp.parse(lines).select("span_id").distinct().count() == lines.count()


def test_the_stream_writes_compressed_files(spark, tmp_path):
    span_rows = spans(spark, span(attributes={"gen_ai.agent.id": "a", "n": "1.50", "user.id": "u"}), span(span_id="2"))
    span_rows.write.parquet(f"{tmp_path}/spans")
    stream = span_files.stream_spans(spark, f"{tmp_path}/spans")
    pipeline.export(stream, f"{tmp_path}/out", f"{tmp_path}/ck", once=True, compression="gzip").awaitTermination()
    files = list((tmp_path / "out" / "batch=0").iterdir())
    assert files and all(f.name.endswith(".txt.gz") for f in files)
    assert sorted(r.span_id for r in otlp.parse(export.read_lines(spark, f"{tmp_path}/out")).collect()) == ["1", "2"]
