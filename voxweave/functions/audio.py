"""Column builders for audio payloads and audio arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import _col


def payload_kind(c: Column | str) -> Column:
    """``url``, ``base64`` or ``path``; null stays null."""
    c = _col(c)
    is_url = c.rlike(r"^(?i)https?://[^/?#]+")
    bare = ~c.contains("/") & ~c.contains("\\") & (F.length(c) > 256)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(is_url, F.lit("url"))
        .when(c.startswith("data:audio") | bare, F.lit("base64"))
        .otherwise(F.lit("path"))
    )


def payload_body(c: Column | str) -> Column:
    """Base64 text of a payload: what follows the first comma of a ``data:`` URL, else everything."""
    c = _col(c)
    return F.when(F.ltrim(c).startswith("data:"), F.regexp_replace(c, r"^[^,]*,", "")).otherwise(c)


def payload_bytes(c: Column | str) -> Column:
    """Decoded bytes of a base64 payload, null for the other kinds and for text that is not base64."""
    return F.when(payload_kind(c) == "base64", F.try_to_binary(payload_body(c), F.lit("base64")))


def resampled_length(frames: Column | str, rate: Column | str, target: int = K.CODEC_RATE) -> Column:
    """Sample count after resampling, rounded down; null when frames or rate are not positive."""
    frames, rate = _col(frames), _col(rate)
    ratio = F.lit(float(target)) / rate.cast("double")
    return F.when((frames > 0) & (rate > 0), F.floor(frames * ratio))


def code_frames(samples: Column | str) -> Column:
    """Code frames of a clip at the codec rate: one per started block of 1920 samples."""
    return F.ceil(_col(samples) / F.lit(K.SAMPLES_PER_FRAME))


def mel_frames(samples: Column | str, n_fft: int = 1024, hop: int = 256) -> Column:
    """Frames of a mel spectrogram after reflect padding by ``(n_fft - hop) // 2`` on both sides."""
    pad = (n_fft - hop) // 2
    padded = _col(samples) + 2 * pad
    return F.when(padded >= n_fft, F.floor((padded - n_fft) / F.lit(hop)) + 1).otherwise(F.lit(0).cast("long"))


def asr_code_length(samples: Column | str, rate: int = 1) -> Column:
    """Codes of the speech-recognition path: pad, 160-sample hop, two convolutions, then down-sampling."""
    block = K.ASR_HOP * 2 * rate
    mel = F.ceil(_col(samples) / F.lit(block)) * F.lit(block // K.ASR_HOP)
    halved = F.floor((mel - 1) / F.lit(2)) + 1
    return F.floor(halved / F.lit(rate))


def voiced_samples(first_codes: Column | str) -> Column:
    """Samples a decoder keeps: frames whose first code is above 0, times 1920.

    A real code 0 counts as padding, as in the decoder this mirrors; ``zero_code_frames`` reports such frames.
    """
    voiced = F.size(F.filter(_col(first_codes), lambda x: x > 0))
    return voiced.cast("long") * K.SAMPLES_PER_FRAME


def zero_code_frames(first_codes: Column | str) -> Column:
    return F.size(F.filter(_col(first_codes), lambda x: x <= 0))


def reference_cut(ref_frames: Column | str, total_frames: Column | str, samples: Column | str) -> Column:
    """Samples to cut from the front when the reference codes were decoded together with the new ones."""
    share = _col(ref_frames).cast("double") / F.greatest(_col(total_frames), F.lit(1))
    return F.floor(share * _col(samples))


def integer_pcm(samples: Column | str, bits: int, signed: bool = True) -> Column:
    """Integer samples scaled to [-1, 1]."""
    half = float(1 << (bits - 1))
    shift = 0.0 if signed else half
    scaled = F.transform(_col(samples), lambda x: (x.cast("double") - F.lit(shift)) / F.lit(half))
    return F.transform(scaled, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))


def float_pcm(samples: Column | str) -> Column:
    """Float samples: unchanged while the peak is within 1 (+1e-6), else divided by the peak; then clipped."""
    doubles = _col(samples).cast("array<double>")
    peak = F.coalesce(F.array_max(F.transform(doubles, F.abs)), F.lit(0.0))
    scale = F.when(peak <= 1.0 + 1e-6, F.lit(1.0)).otherwise(peak + 1e-12)
    return F.transform(doubles, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x / scale)))


def mono(frames: Column | str) -> Column:
    """Mean over channels of ``array<array<double>>`` (one inner array per time step)."""
    return F.transform(
        _col(frames), lambda f: F.aggregate(f, F.lit(0.0), lambda a, x: a + x) / F.size(f)
    )
