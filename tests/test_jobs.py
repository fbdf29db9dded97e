import numpy as np
import pytest
from pyspark.sql import functions as F

from voxweave import jobs
from voxweave.functions.signal import encode_wav
from voxweave.operators import cleaning as C

CLIP = encode_wav(0.5 * np.sin(np.arange(160)), 16000)


def voices(spark, n):
    """Every seventh clip is broken, every fifth text is only a tag."""
    rows = [(i, "<x>" if i % 5 == 0 else f"t {i}", "ja", f"s{i % 2}", b"bad" if i % 7 == 0 else CLIP) for i in range(n)]
    df = spark.createDataFrame(rows, "raw_index long, transcription string, lang string, speaker string, b binary")
    return df.withColumn("audio", F.struct(F.col("b").alias("bytes"), F.lit(None).cast("string").alias("path"))).drop("b")


def urls(spark, n):
    rows = [(i, f"u  {i}", f"http://h/{i}.wav", i, CLIP) for i in range(n)]
    df = spark.createDataFrame(rows, "raw_index long, voice_text string, file_url string, char_id long, b binary")
    return df.withColumn("audio", F.struct(F.col("b").alias("bytes"), F.col("file_url").alias("path"))).drop("b")


def lengths(batch):
    return [[[len(w)] * 16] for w in batch["samples"]]


def test_runs_add_up_to_one_run(spark, folder):
    for n in (6, 20, 20):
        a = C.source_a(voices(spark, n), "org/a", ["ja"], cap=10)
        jobs.prepare_corpus([a, C.source_b(urls(spark, 4), "org/b")], folder)
    got = sorted((r.source, r.raw_index, r.text, r.language) for r in spark.read.parquet(folder).collect())
    want = [("org/a", i, f"t {i}", "japanese") for i in range(20) if i % 5][:10] + [("org/b", i, f"u {i}", "korean") for i in range(4)]
    assert got == sorted(want)
    assert jobs.published(spark, folder).columns == ["audio", "text", "source", "speaker", "language"]


def test_codes_are_attached_once(spark, folder):
    out = folder + "-coded"
    for n in (8, 16, 16):
        jobs.prepare_corpus([C.source_a(voices(spark, n), "org/a")], folder)
        jobs.attach_codes(spark, folder, out, lengths)
    got = spark.read.parquet(out).orderBy("raw_index").collect()
    assert [r.raw_index for r in got] == [i for i in range(16) if i % 5 and i % 7]
    assert all(r.audio_codes == [[240] * 16] for r in got)
    assert jobs.published(spark, out, "minimal").columns == ["audio", "transcript", "speaker", "codes"]
    with pytest.raises(ValueError):
        jobs.attach_codes(spark, folder, folder + "/", lengths)


def test_prepare_with_an_encoder(spark, folder):
    jobs.prepare_corpus([C.source_b(urls(spark, 3), "org/b")], folder, lengths)
    assert jobs.published(spark, folder).where(F.size("audio_codes") == 1).count() == 3
