import io
import math
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxweave.functions import audio as U
from voxweave.functions import signal as S
from voxweave.operators import cleaning as C
from voxweave.operators import clips as A
from voxweave.operators import synthesis as Y


def wav(frames, width, channels, rate):
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(frames)
    return buf.getvalue()


def sine(n, rate, hz=440.0, amp=0.5):
    return amp * np.sin(2 * np.pi * hz * np.arange(n) / rate)


def test_decode_widths_and_channels(spark):
    x = sine(100, 16000)
    stereo = np.stack([x, -x / 2], 1)
    floats = b"RIFF" + struct.pack("<I", 0) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 3, 1, 16000, 64000, 4, 32)
    floats += b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"data" + struct.pack("<I", 400) + x.astype("<f4").tobytes()
    i24 = (x * (1 << 23)).astype(np.int32)
    clips = [
        wav((x * 32768).astype("<i2").tobytes(), 2, 1, 16000),
        wav(((x * 128) + 128).astype(np.uint8).tobytes(), 1, 1, 16000),
        wav((x * (1 << 31)).astype("<i4").tobytes(), 4, 1, 24000),
        wav(b"".join(int(v).to_bytes(3, "little", signed=True) for v in i24), 3, 1, 24000),
        wav((stereo * 32768).astype("<i2").tobytes(), 2, 2, 24000),
        floats,
        b"broken", b"RIFF0000WAVE", None,
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(clips)], "id int, bytes binary")
    got = A.decode_clips(df).orderBy("id").collect()
    assert [r.undecodable for r in got] == [False] * 6 + [True] * 3
    assert [r.rate for r in got[:6]] == [16000, 16000, 24000, 24000, 24000, 16000]
    for r, tol in zip(got[:4], (1e-4, 1e-2, 1e-6, 1e-6)):
        assert np.allclose(r.samples, x, atol=tol)
    assert np.allclose(got[4].samples, x / 4, atol=1e-4) and np.allclose(got[5].samples, x, atol=1e-6)


def test_encode_reads_back_with_the_standard_library(spark):
    df = spark.createDataFrame([([0.0, 0.5, -0.5, 1.5, -1.5], 16000)], "samples array<float>, rate int")
    data = bytes(A.encode_clips(df).first().bytes)
    with wave.open(io.BytesIO(data)) as w:
        assert (w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()) == (16000, 1, 2, 5)
        assert np.frombuffer(w.readframes(5), "<i2").tolist() == [0, 16384, -16384, 32767, -32768]


@pytest.mark.parametrize("rate,target", [(16000, 24000), (44100, 24000), (48000, 16000), (24000, 24000)])
def test_resample_keeps_a_sine(spark, rate, target):
    x = sine(rate // 4, rate)
    df = spark.createDataFrame([(x.tolist(), rate)], "samples array<float>, rate int")
    got = A.resample_clips(df, target).first()
    want = sine(len(got.samples), target)
    assert got.rate == target and len(got.samples) == math.ceil(len(x) * target / rate)
    edge = 200 if rate != target else 0
    assert np.abs(np.array(got.samples) - want)[edge : len(want) - edge].max() < 1e-3


def slow_mel_weight(hz, low, centre, high):
    rise, fall = (hz - low) / (centre - low), (high - hz) / (high - centre)
    return max(0.0, min(rise, fall)) * 2.0 / (high - low)


def test_log_mel_against_a_plain_transform(spark):
    rate, n_fft, hop, win, bins, low, high = 16000, 64, 16, 40, 6, 0.0, 8000.0
    x = sine(200, rate, 1500.0)
    df = spark.createDataFrame([(x.tolist(),)], "samples array<float>")
    got = np.array(A.log_mel_features(df, rate, n_fft, hop, win, bins, low, high).first().mel)

    def mel(hz):
        return hz / (200 / 3) if hz < 1000 else 15 + 27 * math.log(hz / 1000) / math.log(6.4)

    def hertz(m):
        return m * 200 / 3 if m < 15 else 1000 * math.exp((m - 15) * math.log(6.4) / 27)

    edges = [hertz(mel(low) + (mel(high) - mel(low)) * i / (bins + 1)) for i in range(bins + 2)]
    x32 = x.astype(np.float32).astype(float)
    pad = (n_fft - hop) // 2
    padded = np.concatenate([x32[1 : pad + 1][::-1], x32, x32[-pad - 1 : -1][::-1]])
    window = [0.0] * 12 + [0.5 - 0.5 * math.cos(2 * math.pi * i / win) for i in range(win)] + [0.0] * 12
    want = []
    for at in range(0, len(padded) - n_fft + 1, hop):
        row = []
        for b in range(bins):
            total = 0.0
            for k in range(n_fft // 2 + 1):
                w = slow_mel_weight(k * rate / n_fft, *edges[b : b + 3])
                if w > 0:
                    z = sum(padded[at + i] * window[i] * np.exp(-2j * math.pi * k * i / n_fft) for i in range(n_fft))
                    total += w * math.sqrt(abs(z) ** 2 + 1e-9)
            row.append(math.log(max(total, 1e-5)))
        want.append(row)
    assert got.shape == (len(want), bins) == (200 // hop, bins)
    assert np.allclose(got, want, atol=1e-4)


def test_feature_shapes_follow_the_length_rules(spark):
    for n in (0, 100, 255, 256, 384, 385, 512, 4000):
        df = spark.createDataFrame([(sine(n, 24000).tolist(), n)], "samples array<float>, n int")
        frames = len(A.log_mel_features(df).first().mel)
        assert frames == (n // 256 if n > 384 else 0)
        assert df.select(U.mel_frames("n").alias("f")).first().f == n // 256
    clip = spark.createDataFrame([(sine(1000, 16000).tolist(),)], "samples array<float>")
    mel = np.array(A.asr_log_mel(clip, 80, block=320).first().mel)
    assert mel.shape == (8, 80) and mel.max() - mel.min() <= 2.0 + 1e-6


def test_asr_codes_match_the_convolution_rules(spark):
    for n in (1, 319, 320, 321, 16000):
        mel = math.ceil(n / 320) * 2
        after = mel
        for stride in (1, 2):
            after = 1 + (after + 2 - 2 - 1) // stride
        df = spark.createDataFrame([(n,)], "n int")
        assert df.select(U.asr_code_length("n").alias("c")).first().c == after


def test_frames_equal_the_kernel(spark):
    x = sine(50, 16000)
    df = spark.createDataFrame([(1, x.tolist()), (2, [0.1] * 5)], "id int, samples array<double>")
    got = A.frame_signal(df, ["id"], 16, 4).orderBy("id", "frame").collect()
    want = S.frames_of(x, 16, 4, 6)
    assert [r.id for r in got] == [1] * len(want)  # the short clip cannot be reflected
    assert np.allclose([r.window for r in got], want)


def test_pcm(spark):
    df = spark.createDataFrame([([-128, 0, 127], [0, 128, 255], [0.5, -2.0], [[1.0, -1.0], [0.5, 0.5]], [1.0 + 5e-7])],
                               "i array<int>, u array<int>, f array<double>, s array<array<double>>, n array<double>")
    r = df.select(
        U.integer_pcm("i", 8).alias("i"), U.integer_pcm("u", 8, False).alias("u"), U.float_pcm("f").alias("f"),
        U.mono("s").alias("s"), U.float_pcm("n").alias("n"),
    ).first()
    assert r.i == [-1.0, 0.0, 127 / 128] and r.u == [-1.0, 0.0, 127 / 128]
    assert r.f == pytest.approx([0.25, -1.0]) and r.s == [0.0, 0.5] and r.n == [1.0]


def test_lengths_without_rate_are_null(spark):
    df = spark.createDataFrame([(48000, 16000), (0, 16000), (5, 0)], "n int, r int")
    assert [x[0] for x in df.select(U.resampled_length("n", "r")).collect()] == [72000, None, None]


def test_unify_orders_the_forms(spark):
    kind = "struct<bytes:binary,path:string,filename:string,samples:array<float>,rate:int>"
    rows = [
        (0, "p.wav", None), (1, None, (b"b", "x.wav", "y.wav", [0.1], 8000)), (2, None, (None, None, None, [0.1], 8000)),
        (3, None, (None, None, "p.wav", None, None)), (4, None, (None, "gone.wav", None, None, None)), (5, None, None), (6, "gone.wav", None),
    ]
    df = spark.createDataFrame(rows, f"raw_index int, audio_path string, audio {kind}")
    files = spark.createDataFrame([("p.wav", b"file")], "path string, content binary")
    got = {r.raw_index: r.audio_value for r in C.audio_value_unify(df, "org/voices", files=files).collect()}
    assert bytes(got[0].bytes) == b"file" and got[0].path == "p.wav"
    assert bytes(got[1].bytes) == b"b" and got[1].path == "x.wav"
    assert len(got[2].bytes) == 46 and got[2].path == "voices_2.wav"
    assert bytes(got[3].bytes) == b"file" and got[4].bytes is None and got[4].path == "gone.wav"
    assert got[5].bytes is None and got[6].bytes is None


# ---------------------------------------------------------------- user callables


def memory_hungry(limit, poison=()):
    def call(batch):
        if len(batch) > limit or batch["id"].isin(poison).any():
            raise RuntimeError("CUDA out of memory")
        return [[[i]] for i in batch["id"]]

    return call


def test_bisect(spark):
    df = spark.range(70).repartition(2)
    got = Y.attach_codes(df, memory_hungry(3, (5, 40)), inputs=["id"]).collect()
    assert sorted(r.id for r in got) == [i for i in range(70) if i not in (5, 40)]
    assert all(r.audio_codes == [[r.id]] for r in got)
    assert Y.attach_codes(df, memory_hungry(0), inputs=["id"]).count() == 0


def test_other_errors_stop_the_job(spark):
    def broken(batch):
        raise KeyError("no such thing")

    with pytest.raises(Exception, match="no such thing"):
        Y.batch_encoder_udf(spark.range(3), broken).collect()
    assert not Y.out_of_memory(RuntimeError("out of memory")) and Y.out_of_memory(RuntimeError("cublas_status_alloc_failed"))


def test_batches_stay_within_their_size(spark):
    sizes = Y.batch_map(spark.range(100).coalesce(1), lambda b: [len(b)] * len(b), "n", "int", 32).collect()
    assert sorted(r.n for r in sizes) == [4] * 4 + [32] * 96


def test_synthesis_never_sees_invalid_requests(spark):
    rows = [(1, "hi", "English"), (2, " ", "English"), (3, "hi", None), (4, "hi", "AUTO"), (5, "boom", "english")]
    df = spark.createDataFrame(rows, "request_id int, text string, language string")
    ids = spark.createDataFrame([("english", 7)], "language string, language_id int")

    def model(batch):
        assert batch["prompt"].str.len().min() > 0
        if batch["prompt"].str.contains("boom").any():
            raise RuntimeError("cuda out of memory")
        return [[1, 2]] * len(batch)

    got = {r.request_id: (r.codes, r.error) for r in Y.batch_synthesis_job(df, model, ids).collect()}
    assert got == {
        1: ([1, 2], None), 2: (None, "empty text"), 3: (None, "unsupported language"), 4: ([1, 2], None), 5: (None, "out of memory"),
    }


def test_prompts(spark):
    df = spark.createDataFrame([(1, True, "t"), (2, None, "t")], "id int, x_vector_only_mode boolean, ref_text string")
    got = Y.build_clone_prompts(df, F.array(F.lit(1.0)), F.array(F.array(F.lit(5))), ["id"]).orderBy("id").collect()
    assert [(r.ref_code, r.x_vector_only_mode, r.icl_mode) for r in got] == [(None, True, False), ([[5]], False, True)]
