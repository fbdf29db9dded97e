"""Jobs over tables of clips. Everything that needs no signal processing is a plain expression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import audio as U
from ..functions.signal import asr_log_mel as asr_kernel
from ..functions.signal import decode_wav, encode_wav, hann, mel_bank, resample
from ..functions.signal import log_mel as mel_kernel
from ..functions.text import _col
from ..functions.vectors import list_column, waves

DECODED = "struct<samples:array<float>,rate:int>"
FEATURES = "array<array<float>>"


def wav_bytes(samples: Column | str, rate: Column | str) -> Column:
    """16-bit PCM WAV of a sample array."""

    @F.arrow_udf("binary")
    def made(wave: pa.Array, rates: pa.Array) -> pa.Array:
        pairs = zip(waves(wave), rates.to_pylist())
        return pa.array([None if w is None or r is None else encode_wav(w, r) for w, r in pairs], pa.binary())

    return made(_col(samples).cast("array<double>"), _col(rate).cast("int"))


def encode_clips(df: DataFrame, samples: str = "samples", rate: str = "rate", into: str = "bytes") -> DataFrame:
    return df.withColumn(into, wav_bytes(samples, rate))


def decode_clips(df: DataFrame, data: str = "bytes") -> DataFrame:
    """Mono samples and rate of every clip; ``undecodable`` marks clips that are no WAV.

    Every clip is decoded once, also under filters on the result.
    """

    @F.arrow_udf(DECODED)
    def decoded(items: pa.Array) -> pa.Array:
        made = [decode_wav(item.as_py()) for item in items]
        samples = list_column([None if clip is None else clip[0] for clip in made])
        rates = pa.array([None if clip is None else clip[1] for clip in made], pa.int32())
        lost = pa.array([clip is None for clip in made], pa.bool_())
        return pa.StructArray.from_arrays([samples, rates], names=["samples", "rate"], mask=lost)

    out = df.withColumn("_clip", decoded.asNondeterministic()(F.col(data)))
    return out.withColumns(
        {
            "samples": F.col("_clip")["samples"],
            "rate": F.col("_clip")["rate"],
            "undecodable": F.col("_clip").isNull(),
        }
    ).drop("_clip")


def resample_clips(df: DataFrame, target: int = K.CODEC_RATE, samples: str = "samples", rate: str = "rate") -> DataFrame:
    """Clips at another rate are resampled; clips already at ``target`` never leave the JVM."""

    @F.arrow_udf("array<float>")
    def moved(wave: pa.Array, rates: pa.Array) -> pa.Array:
        pairs = zip(waves(wave), rates.to_pylist())
        return list_column([None if w is None or r is None else resample(w, r, target) for w, r in pairs])

    other = F.col(rate) != target
    converted = moved.asNondeterministic()(F.when(other, F.col(samples)).cast("array<float>"), F.when(other, F.col(rate)).cast("int"))
    return df.withColumns(
        {samples: F.when(other, converted).otherwise(F.col(samples).cast("array<float>")), rate: F.lit(target)}
    )


def clip_report(df: DataFrame, samples: str = "samples", rate: str = "rate", target: int = K.CODEC_RATE) -> DataFrame:
    """Per clip: seconds, samples at the codec rate, code frames, and whether any sample leaves [-1, 1]."""
    n = F.size(samples)
    outside = (F.array_min(samples) < -1.0) | (F.array_max(samples) > 1.0)
    return df.withColumns(
        {
            "n_samples": n,
            "seconds": F.try_divide(n, F.col(rate)),
            "codec_samples": U.resampled_length(n, rate, target),
            "code_frames": U.code_frames(U.resampled_length(n, rate, target)),
            "out_of_range": F.coalesce(outside, F.lit(False)),
        }
    )


def clip_totals(report: DataFrame, source: str = "source") -> DataFrame:
    return report.groupBy(source).agg(
        F.count(F.lit(1)).alias("clips"),
        F.sum("seconds").alias("seconds"),
        F.sum("code_frames").alias("code_frames"),
        F.count_if("out_of_range").alias("out_of_range"),
    )


def frame_signal(df: DataFrame, keep: list[str], n_fft: int, hop: int, samples: str = "samples", pad: int | None = None) -> DataFrame:
    """One row per overlapping frame after reflect padding by ``(n_fft - hop) // 2``."""
    pad = (n_fft - hop) // 2 if pad is None else pad
    wave, n = F.col(samples), F.size(samples)
    head = F.reverse(F.slice(wave, 2, pad)) if pad else F.slice(wave, 1, 0)
    tail = F.reverse(F.slice(wave, n - pad, pad)) if pad else F.slice(wave, 1, 0)
    long_enough = (n > pad) & (n + 2 * pad >= n_fft)
    # Clips too short to reflect are dropped before any slice is evaluated.
    padded = df.where(long_enough).select(*keep, F.concat(head, wave, tail).alias("_w"))
    starts = F.sequence(F.lit(0), F.size("_w") - n_fft, F.lit(hop))
    return padded.select(*keep, "_w", F.posexplode(starts).alias("frame", "_s")).select(
        *keep, "frame", F.slice("_w", F.col("_s") + 1, n_fft).alias("window")
    )


def _feature(df: DataFrame, samples: str, into: str, kernel) -> DataFrame:
    @F.arrow_udf(FEATURES)
    def features(wave: pa.Array) -> pa.Array:
        made = [None if w is None else kernel(w) for w in waves(wave)]
        if any(m is not None for m in made):
            return list_column(made)
        return pa.array(made, pa.list_(pa.list_(pa.float32())))

    return df.withColumn(into, features(F.col(samples).cast("array<float>")))


def log_mel_features(df: DataFrame, rate: int = 24000, n_fft: int = 1024, hop: int = 256, window: int = 1024, bins: int = 128,
                     low: float = 0.0, high: float = 12000.0, samples: str = "samples", into: str = "mel") -> DataFrame:
    """Natural-log mel features (frames x bins). The 16 kHz setting is 1024/160/640, 80 bins, 0-8 kHz."""
    bank, shape = mel_bank(rate, n_fft, bins, low, high), hann(window, n_fft)
    return _feature(df, samples, into, lambda w: mel_kernel(w, bank, shape, hop))


def asr_log_mel(df: DataFrame, bins: int = 128, samples: str = "samples", into: str = "mel", block: int | None = None,
                n_fft: int = 400, hop: int = 160, rate: int = 16000) -> DataFrame:
    """Speech-recognition features (frames x bins) of 16 kHz clips.

    ``block`` pads a clip with zeros to a multiple of that many samples first. The floor depends on the maximum of
    the whole clip, so a clip is one call.
    """
    bank, shape = mel_bank(rate, n_fft, bins, 0.0, rate / 2), hann(n_fft, n_fft)

    def kernel(wave: np.ndarray) -> np.ndarray:
        return asr_kernel(wave, bank, shape, hop, -len(wave) % block if block else 0)

    return _feature(df, samples, into, kernel)
