"""NumPy kernels for PCM, framing, mel features and resampling. They only ever see one clip or one batch."""

from __future__ import annotations

import struct

import numpy as np


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """16-bit mono PCM WAV; samples outside [-1, 1] are clipped."""
    pcm = np.clip(np.floor(np.asarray(samples, np.float64) * 32768.0), -32768, 32767).astype("<i2").tobytes()
    head = b"RIFF" + struct.pack("<I", 36 + len(pcm)) + b"WAVE"
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16)
    return head + fmt + b"data" + struct.pack("<I", len(pcm)) + pcm


def decode_wav(data: bytes) -> tuple[np.ndarray, int] | None:
    """Mono samples and rate of a PCM or float WAV; null when the bytes are not one."""
    if data is None or len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None
    at, layout, body = 12, None, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        chunk = data[at + 8 : at + 8 + size]
        if name == b"fmt " and len(chunk) >= 16:
            layout = struct.unpack("<HHIIHH", chunk[:16])
        elif name == b"data":
            body = chunk
            break
        at += 8 + size + (size & 1)
    if layout is None or body is None:
        return None
    tag, channels, rate, _, _, bits = layout
    if channels < 1 or rate < 1:
        return None
    if tag == 3 and bits in (32, 64):
        wide = np.frombuffer(body[: len(body) // (bits // 8) * (bits // 8)], f"<f{bits // 8}").astype(np.float64)
    elif tag in (1, 65534) and bits == 8:
        wide = (np.frombuffer(body, np.uint8).astype(np.float64) - 128.0) / 128.0
    elif tag in (1, 65534) and bits in (16, 32):
        step = bits // 8
        wide = np.frombuffer(body[: len(body) // step * step], f"<i{step}").astype(np.float64) / float(1 << (bits - 1))
    elif tag in (1, 65534) and bits == 24:
        raw = np.frombuffer(body[: len(body) // 3 * 3], np.uint8).reshape(-1, 3).astype(np.int32)
        whole = raw[:, 0] | (raw[:, 1] << 8) | (raw[:, 2] << 16)
        wide = (whole - ((whole & 0x800000) << 1)) / float(1 << 23)
    else:
        return None
    frames = len(wide) // channels
    return wide[: frames * channels].reshape(frames, channels).mean(1), rate


def mel_bank(rate: int, n_fft: int, bins: int, low: float, high: float) -> np.ndarray:
    """Triangular filters on the Slaney mel scale, each with unit area: (bins, n_fft // 2 + 1)."""
    # The scale is linear (200/3 Hz per mel) up to 1 kHz and logarithmic above, 27 steps per factor 6.4.
    knee, step = 1000.0, 200.0 / 3.0
    log_step = np.log(6.4) / 27.0

    def to_mel(hz: np.ndarray) -> np.ndarray:
        above = knee / step + np.log(np.maximum(hz, knee) / knee) / log_step
        return np.where(hz < knee, hz / step, above)

    def to_hz(mel: np.ndarray) -> np.ndarray:
        above = knee * np.exp(log_step * (np.maximum(mel, knee / step) - knee / step))
        return np.where(mel < knee / step, mel * step, above)

    edges = to_hz(np.linspace(*to_mel(np.array([low, high], np.float64)), bins + 2))
    grid = np.fft.rfftfreq(n_fft, 1.0 / rate)
    left, centre, right = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    rise, fall = (grid - left) / (centre - left), (right - grid) / (right - centre)
    return np.maximum(0.0, np.minimum(rise, fall)) * (2.0 / (right - left))


def hann(length: int, n_fft: int) -> np.ndarray:
    """Periodic Hann window centred in ``n_fft`` zeros."""
    window = 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(length) / length)
    pad = (n_fft - length) // 2
    return np.pad(window, (pad, n_fft - length - pad))


def frames_of(samples: np.ndarray, n_fft: int, hop: int, pad: int) -> np.ndarray:
    """Overlapping frames after reflect padding; none when the clip is too short to reflect."""
    if len(samples) <= pad or len(samples) + 2 * pad < n_fft:
        return np.empty((0, n_fft))
    padded = np.pad(samples, (pad, pad), mode="reflect")
    return np.lib.stride_tricks.sliding_window_view(padded, n_fft)[::hop]


def log_mel(samples: np.ndarray, bank: np.ndarray, window: np.ndarray, hop: int) -> np.ndarray:
    """Natural-log mel magnitudes, (frames, bins)."""
    n_fft = len(window)
    cut = frames_of(np.asarray(samples, np.float64), n_fft, hop, (n_fft - hop) // 2)
    spectrum = np.fft.rfft(cut * window, axis=1)
    magnitude = np.sqrt(spectrum.real**2 + spectrum.imag**2 + 1e-9)
    return np.log(np.maximum(magnitude @ bank.T, 1e-5))


def asr_log_mel(samples: np.ndarray, bank: np.ndarray, window: np.ndarray, hop: int, padding: int = 0) -> np.ndarray:
    """Log10 power mel with a floor 8 below the clip's own maximum, scaled by (x + 4) / 4; (frames, bins)."""
    n_fft = len(window)
    clip = np.pad(np.asarray(samples, np.float64), (0, padding))
    cut = frames_of(clip, n_fft, hop, n_fft // 2)[:-1]
    power = np.abs(np.fft.rfft(cut * window, axis=1)) ** 2
    logs = np.log10(np.maximum(power @ bank.T, 1e-10))
    if logs.size:
        logs = np.maximum(logs, logs.max() - 8.0)
    return (logs + 4.0) / 4.0


def resample(samples: np.ndarray, rate: int, target: int, zeros: int = 32) -> np.ndarray:
    """Band-limited resampling with a Hann-windowed sinc; output length is ceil(n * target / rate).

    The ratio is a fraction up/down, so output samples fall into ``up`` phases with one filter each.
    """
    samples = np.asarray(samples, np.float64)
    if rate == target or not len(samples):
        return samples
    shared = int(np.gcd(rate, target))
    up, down = target // shared, rate // shared
    cutoff = min(1.0, target / rate)
    half = int(np.ceil(zeros / cutoff))
    taps = np.arange(-half + 1, half + 1)
    count = -(-len(samples) * target // rate)
    padded = np.pad(samples, (half - 1, half + down))
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * half)
    out = np.empty(count)
    for phase in range(min(up, count)):
        base, rest = divmod(phase * down, up)
        offset = taps - rest / up
        reach = np.clip(offset * cutoff / zeros, -1.0, 1.0)
        weight = np.sinc(offset * cutoff) * cutoff * (0.5 + 0.5 * np.cos(np.pi * reach))
        rows = len(range(phase, count, up))
        out[phase::up] = windows[base : base + (rows - 1) * down + 1 : down] @ weight
    return out
