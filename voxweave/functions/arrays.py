"""Token-sequence column builders: parsing, cutting, padding, training layouts, masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import _col


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def ints(*values: int) -> Column:
    return F.array(*[_int(v) for v in values])


def repeat(value: Column, times: Column | int) -> Column:
    return F.array_repeat(value, times if isinstance(times, int) else times.cast("int"))


def first_codes(codes: Column | str) -> Column:
    """First code of every frame."""
    return F.transform(_col(codes), lambda frame: F.get(frame, _int(0)))


def parse_codes(codes: Column | str, width: int = K.CODEBOOKS) -> Column:
    """Codes as (T, width). A (width, T) matrix is turned; a square one is kept; anything else is null."""
    codes = _col(codes)
    inner = F.size(F.get(codes, _int(0)))
    turned = F.transform(
        F.sequence(_int(0), inner - 1), lambda t: F.transform(codes, lambda row: F.get(row, t))
    )
    upright = F.forall(codes, lambda row: F.size(row) == width)
    even = F.forall(codes, lambda row: F.size(row) == inner)
    return F.when(upright & (F.size(codes) > 0), codes).when((F.size(codes) == width) & even & (inner > 0), turned)


def column_codes(codes: Column | str) -> Column:
    """One-dimensional codes as a single-column matrix."""
    return F.transform(_col(codes), lambda x: F.array(x))


def has_code_shape(codes: Column | str, width: int = K.CODEBOOKS) -> Column:
    return F.forall(_col(codes), lambda frame: F.size(frame) == width)


def is_reserved_code(code: Column, vocab: int, reserved: int = K.RESERVED_TAIL, end_id: int = K.CODEC_EOS) -> Column:
    """Ids in ``[vocab - reserved, vocab)`` other than the end id never belong in the output."""
    return code.between(vocab - reserved, vocab - 1) & (code != end_id)


def truncate_at_eos(codes: Column | str, end_id: int = K.CODEC_EOS) -> Column:
    """Frames before the first whose first code is ``end_id``; all frames when there is none."""
    codes = _col(codes)
    at = F.array_position(first_codes(codes), _int(end_id)).cast("int")
    return F.when(at > 0, F.slice(codes, 1, at - 1)).otherwise(codes)


def prepend_codes(reference: Column | str, generated: Column | str) -> Column:
    generated = _col(generated)
    return F.when(_col(reference).isNull(), generated).otherwise(F.concat(_col(reference), generated))


def drop_ends(ids: Column | str, head: int, tail: int) -> Column:
    """Python's ``ids[head:-tail]``."""
    ids = _col(ids)
    return F.slice(ids, head + 1, F.greatest(F.size(ids) - (head + tail), _int(0)))


def pad_right(values: Column | str, width: Column, fill: Column) -> Column:
    values = _col(values)
    return F.concat(values, repeat(fill, width - F.size(values)))


def pad_left(values: Column | str, width: Column, fill: Column) -> Column:
    values = _col(values)
    return F.concat(repeat(fill, width - F.size(values)), values)


def as_text(values: Column | str) -> Column:
    """Values joined by commas."""
    return F.array_join(_col(values).cast("array<string>"), ",")


def pad_right_text(values: Column | str, width: Column, fill: int) -> Column:
    """``pad_right`` as text, of values that are not empty; the fill is one repeated text."""
    values = _col(values)
    return F.concat(as_text(values), F.repeat(F.lit(f",{fill}"), (width - F.size(values)).cast("int")))


def _run_lengths(width: Column, runs: tuple) -> list[tuple[bool, Column]]:
    """(value, length) of runs (end, value) in order; what is left of ``width`` is false, ends beyond it are cut."""
    width = F.greatest(width.cast("int"), _int(0))
    parts, at = [], _int(0)
    for end, value in (*runs, (width, False)):
        end = F.least(F.greatest(_int(end) if isinstance(end, int) else end.cast("int"), at), width)
        parts.append((value, end - at))
        at = end
    return parts


def flag_runs(width: Column, *runs: tuple[Column | int, bool], text: bool = False) -> Column:
    """Flags of ``width`` positions from runs (end, value) in order, as an array of booleans; what is left is false.

    A run is one repeated value, so nothing is worked out position by position. Ends beyond the width are cut. With
    ``text`` the flags are a string of 0 and 1, one character a position.
    """
    parts = _run_lengths(width, runs)
    if text:
        return F.concat(*[F.repeat(F.lit("1" if value else "0"), n) for value, n in parts])
    return F.concat(*[repeat(F.lit(value), n) for value, n in parts])


def right_mask(length: Column, width: Column, text: bool = False) -> Column:
    return flag_runs(width, (length, True), text=text)


def left_mask(length: Column, width: Column) -> Column:
    return flag_runs(width, (width - length, False), (width, True))


# ---------------------------------------------------------------- training layout
# A sequence has Lt text ids and Lc code frames and is Lt + Lc + 8 positions long.


def sequence_length(text_ids: Column | str, codes: Column | str) -> Column:
    return F.size(_col(text_ids)) + F.size(_col(codes)) + 8


def text_channel(text_ids: Column | str, codes: Column | str, pad=K.TTS_PAD, bos=K.TTS_BOS, eos=K.TTS_EOS) -> Column:
    text_ids, codes = _col(text_ids), _col(codes)
    return F.concat(
        F.slice(text_ids, 1, 3),
        repeat(_int(pad), 4),
        ints(bos),
        F.slice(text_ids, 4, F.greatest(F.size(text_ids) - 3, _int(0))),
        ints(eos),
        repeat(_int(pad), F.size(codes) + 2),
    )


def codec_channel(
    text_ids: Column | str, codes: Column | str, nothink=K.CODEC_NOTHINK, think_bos=K.CODEC_THINK_BOS,
    think_eos=K.CODEC_THINK_EOS, pad=K.CODEC_PAD, bos=K.CODEC_BOS, eos=K.CODEC_EOS, speaker_slot=0,
) -> Column:
    text_ids, codes = _col(text_ids), _col(codes)
    return F.concat(
        ints(0, 0, 0, nothink, think_bos, think_eos, speaker_slot, pad),
        repeat(_int(pad), F.size(text_ids) - 2),
        ints(bos),
        first_codes(codes),
        ints(eos),
    )


def sequence_labels(text_ids: Column | str, codes: Column | str, eos=K.CODEC_EOS) -> Column:
    return F.concat(
        repeat(_int(K.LABEL_IGNORE), F.size(_col(text_ids)) + 7), first_codes(codes), ints(eos)
    )


def sequence_labels_text(text_ids: Column | str, codes: Column | str, width: Column, eos=K.CODEC_EOS) -> Column:
    """``sequence_labels`` padded to ``width`` as text; only first codes are written one by one."""
    ignored = F.repeat(F.lit(f"{K.LABEL_IGNORE},"), F.size(_col(text_ids)) + 7)
    rest = width - (F.size(_col(text_ids)) + 7)
    return F.concat(ignored, pad_right_text(F.concat(first_codes(codes), ints(eos)), rest, K.LABEL_IGNORE))


def code_matrix(text_ids: Column | str, codes: Column | str, width: int = K.CODEBOOKS) -> Column:
    zero = ints(*[0] * width)
    return F.concat(repeat(zero, F.size(_col(text_ids)) + 7), _col(codes), F.array(zero))


def code_matrix_text(text_ids: Column | str, codes: Column | str, width: Column, codebooks: int = K.CODEBOOKS) -> Column:
    """``code_matrix`` padded to ``width`` as text: codes joined by commas, rows by semicolons.

    Rows of zeros are one repeated text; only frames are written code by code.
    """
    text, codes = F.size(_col(text_ids)), _col(codes)
    zero = ",".join(["0"] * codebooks)

    def zeros(n: Column) -> Column:
        return F.when(n > 0, F.concat(F.lit(zero), F.repeat(F.lit(";" + zero), (n - 1).cast("int"))))

    frames = F.transform(codes, lambda f: F.array_join(f.cast("array<string>"), ","))
    parts = F.concat(F.array(zeros(text + 7)), frames, F.array(F.lit(zero), zeros(width - sequence_length(text_ids, codes))))
    return F.when(text.isNotNull() & width.isNotNull(), F.array_join(parts, ";"))


def attention_mask(length: Column, width: Column, text: bool = False) -> Column:
    return right_mask(length, width, text)


def codec_embedding_mask(length: Column, width: Column, text: bool = False) -> Column:
    """Positions 3.. of the sequence except 6, which is kept for the speaker vector."""
    runs = ((F.least(_int(3), length), False), (F.least(_int(6), length), True), (F.least(_int(7), length), False), (length, True))
    return flag_runs(width, *runs, text=text)


def codec_mask(text_length: Column, frames: Column, width: Column, text: bool = False) -> Column:
    """The positions that hold code frames."""
    return flag_runs(width, (text_length + 7, False), (text_length + 7 + frames, True), text=text)


# ---------------------------------------------------------------- preference and generation layouts


def shift_inputs(values: Column | str) -> Column:
    values = _col(values)
    return F.slice(values, 1, F.greatest(F.size(values) - 1, _int(0)))


def shift_labels(values: Column | str) -> Column:
    values = _col(values)
    return F.slice(values, 2, F.greatest(F.size(values) - 1, _int(0)))


def shift_inputs_text(values: Column | str) -> Column:
    values = _col(values)
    return values.substr(F.lit(1), F.length(values) - F.length(F.substring_index(values, ",", -1)) - 1)


def shift_labels_text(values: Column | str) -> Column:
    values = _col(values)
    return values.substr(F.length(F.substring_index(values, ",", 1)) + 2, F.length(values))


def prefix(values: Column | str, width: Column, fill: Column) -> Column:
    return F.concat(repeat(fill, width), _col(values))


def codec_prefill(language_id: Column, speaker_id: Column) -> Column:
    """Codec ids in front of generation; null language means no language tag, null speaker no speaker slot."""
    tagged = F.array(_int(K.CODEC_THINK), _int(K.CODEC_THINK_BOS), language_id.cast("int"), _int(K.CODEC_THINK_EOS))
    untagged = ints(K.CODEC_NOTHINK, K.CODEC_THINK_BOS, K.CODEC_THINK_EOS)
    empty = F.array().cast("array<int>")
    return F.concat(
        F.when(language_id.isNull(), untagged).otherwise(tagged),
        F.when(speaker_id.isNull(), empty).otherwise(F.array(speaker_id.cast("int"))),
        ints(K.CODEC_PAD, K.CODEC_BOS),
    )


def aligned_text(text: Column | str, codec: Column | str, pad: int = K.TTS_PAD) -> Column:
    """Text side next to the codec side: cut to, or padded up to, the codec length."""
    text, codec = _col(text), _col(codec)
    cut = F.slice(text, 1, F.size(codec))
    return F.concat(cut, repeat(_int(pad), F.size(codec) - F.size(cut)))


def remaining_text(text: Column | str, codec: Column | str) -> Column:
    """Text ids that do not fit beside the codec ids."""
    text, codec = _col(text), _col(codec)
    return F.slice(text, F.size(codec) + 1, F.greatest(F.size(text) - F.size(codec), _int(0)))


def chunk_plan(frames: Column, chunk: int = K.CHUNK_FRAMES, context: int = K.CHUNK_CONTEXT) -> Column:
    """Array of (start, end, context, from) covering ``frames`` positions; ``from`` is ``start - context``."""
    starts = F.sequence(F.lit(0).cast("long"), frames.cast("long") - 1, F.lit(chunk).cast("long"))

    def part(start: Column) -> Column:
        left = F.when(start - context > 0, F.lit(context).cast("long")).otherwise(start)
        end = F.least(start + chunk, frames.cast("long"))
        return F.struct(
            start.alias("start"), end.alias("end"), left.alias("context"), (start - left).alias("from")
        )

    return F.when(frames > 0, F.transform(starts, part)).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint,context:bigint,from:bigint>>")
    )


def masked_frames(mask: Column | str, codes: Column | str) -> Column:
    """Array of (position, frame) at the positions where ``mask`` is true."""
    pairs = F.zip_with(_col(mask), _col(codes), lambda m, c: F.struct(m.alias("m"), c.alias("frame")))
    numbered = F.transform(
        pairs, lambda p, i: F.struct(i.alias("position"), p["frame"].alias("frame"), p["m"].alias("m"))
    )
    return F.filter(numbered, lambda p: p["m"])
