"""Training batches: sequences laid out per row and padded to the longest of their batch.

``plan_batches`` numbers slim rows (key, source, lengths) and finds the widest of every batch, so texts and codes move at
most once, to their batch, and arrays are built where they stay. Without such a plan the widths come from a window over
the rows themselves; a batch has a few dozen rows, so that never builds a large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import arrays as A
from ..functions.batches import text_slices
from ..functions.text import _col
from ..session import compact_files, measured, small_batches
from .ordering import SPAN, fixed_batches

LAYOUT = (
    "text_channel", "codec_channel", "labels", "code_matrix", "attention_mask", "text_embedding_mask", "codec_embedding_mask", "codec_mask",
)


def plan_batches(df: DataFrame, key: str, lengths: dict[str, Column], size: int = K.ENCODE_BATCH, source: str = "source",
                 span: int = SPAN) -> DataFrame:
    """(key, source, batch, and for each entry of ``lengths`` the largest in the batch), one slim row for each row of ``df``."""
    slim = df.select(key, source, *[c.cast("int").alias(f"_{n}") for n, c in lengths.items()])
    placed = fixed_batches(slim, size, source, key, span).drop("slot")
    batch = Window.partitionBy(source, "batch")
    return placed.select(key, source, "batch", *[F.max(f"_{n}").over(batch).alias(n) for n in lengths])


def with_plan(df: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """``df`` with the columns of its plan; a short plan is broadcast, so that no row of ``df`` moves."""
    return df.drop(*[c for c in plan.columns if c != key]).join(measured(plan), key)


def code_point_ids(df: DataFrame, text: str, into: str, head: tuple[int, ...] = (), tail: tuple[int, ...] = ()) -> DataFrame:
    """Code points of a text between fixed ids, as ``array<int>``; a null text gives null.

    Texts are brought to four bytes a character, about ``SLICE`` bytes of them at a time, so nothing is done character by
    character and a task holds ids of one slice whatever the Arrow batch holds. Arrow batches end by bytes of text as well
    as by rows, so a worker's memory follows neither the size of its part nor that of a text, the longest one aside.
    """
    small_batches(df.sparkSession)
    schema = T.StructType(list(df.schema.fields)).add(into, T.ArrayType(T.IntegerType()))
    return df.mapInArrow(_code_points(df.columns.index(text), into, np.array(head, np.int32), np.array(tail, np.int32)), schema)


def _code_points(at: int, into: str, head: np.ndarray, tail: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, n in text_slices(whole.column(at)):
                batch = whole.slice(first, n)
                texts = batch.column(at)
                parts, ends = [], np.zeros(n + 1, np.int32)
                for k, value in enumerate(texts.to_pylist()):
                    points = np.frombuffer((value or "").replace("\0", "").encode("utf-32-le"), np.int32)
                    parts += [head, points, tail]
                    ends[k + 1] = ends[k] + len(head) + len(points) + len(tail)
                valid = np.append(np.asarray(texts.is_valid()), True)
                lists = pa.ListArray.from_arrays(pa.array(ends, mask=~valid), pa.array(np.concatenate(parts)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, into])

    return run


def batch_width(length: Column, batch: list[str]) -> Column:
    return F.max(length).over(Window.partitionBy(*batch))


def _measured(df: DataFrame, values: str, batch: list[str], width: str | None = None) -> DataFrame:
    return df.withColumns({"_length": F.size(values), "_width": batch_width(F.size(values), batch) if width is None else F.col(width)})


def pad_right_batch(df: DataFrame, values: str, batch: list[str], fill: Column | int = 0, mask: str = "mask",
                    width: str | None = None) -> DataFrame:
    """Values padded on the right to the batch maximum, and a mask of the real positions. ``width`` is a planned maximum."""
    fill = A._int(fill) if isinstance(fill, int) else fill
    df = _measured(df, values, batch, width)
    padded = A.pad_right(values, F.col("_width"), fill)
    return df.withColumns({mask: A.right_mask(F.col("_length"), F.col("_width")), values: padded}).drop("_width", "_length")


def pad_left_batch(df: DataFrame, values: str, batch: list[str], fill: Column | int = 0, mask: str = "mask",
                   width: str | None = None) -> DataFrame:
    fill = A._int(fill) if isinstance(fill, int) else fill
    df = _measured(df, values, batch, width)
    padded = A.pad_left(values, F.col("_width"), fill)
    return df.withColumns({mask: A.left_mask(F.col("_length"), F.col("_width")), values: padded}).drop("_width", "_length")


def instruct_pad_mask(df: DataFrame, ids: str, batch: list[str], mask: str = "instruct_mask", width: str | None = None) -> DataFrame:
    """As ``pad_right_batch``; a null instruction is an empty one, so its mask is all false."""
    return pad_right_batch(df.withColumn(ids, F.coalesce(ids, F.array().cast("array<int>"))), ids, batch, 0, mask, width)


def assemble_sequences(df: DataFrame, text_ids: str, codes: str, batch: list[str], which: set[str] | None = None,
                       width: str | None = None, as_text: bool | set[str] = False) -> DataFrame:
    """All training tensors of a batch; ``which`` picks some of them.

    With ``as_text`` (or those it names) the masks (a string of 0 and 1), the channels and labels (joined by commas) and the
    code matrix (codes joined by commas, rows by semicolons) are text, put together run by run, for output that is text anyway.
    Parquet that the session writes is compressed with zstd then (``session.compact_files``).

    With ``width``, the planned maximum of the batch, nothing moves. Without it the maximum is taken by a window, before
    layout expressions, so what moves is the input row and not the padded tensors.
    """
    text, frames = F.size(_col(text_ids)), F.size(_col(codes))
    length = A.sequence_length(text_ids, codes)
    df = df.withColumn("_width", batch_width(length, batch) if width is None else F.col(width))
    width = F.col("_width")
    zero_row = A.ints(*[0] * K.CODEBOOKS)
    texts = set(LAYOUT) if as_text is True else as_text or set()
    if texts:
        compact_files(df.sparkSession)

    def padded(name: str, values: Column, fill: int) -> Column:
        return A.pad_right_text(values, width, fill) if name in texts else A.pad_right(values, width, A._int(fill))

    made = {
        "text_channel": padded("text_channel", A.text_channel(text_ids, codes), 0),
        "codec_channel": padded("codec_channel", A.codec_channel(text_ids, codes), 0),
        "labels": A.sequence_labels_text(text_ids, codes, width) if "labels" in texts
        else A.pad_right(A.sequence_labels(text_ids, codes), width, A._int(K.LABEL_IGNORE)),
        "code_matrix": A.code_matrix_text(text_ids, codes, width) if "code_matrix" in texts
        else A.pad_right(A.code_matrix(text_ids, codes), width, zero_row),
        "attention_mask": A.attention_mask(length, width, "attention_mask" in texts),
        "text_embedding_mask": A.attention_mask(length, width, "text_embedding_mask" in texts),
        "codec_embedding_mask": A.codec_embedding_mask(length, width, "codec_embedding_mask" in texts),
        "codec_mask": A.codec_mask(text, frames, width, "codec_mask" in texts),
    }
    return df.withColumns({k: v for k, v in made.items() if which is None or k in which}).drop("_width")


def instruct_prefix(df: DataFrame, instruct_mask: str = "instruct_mask", as_text: set[str] = frozenset()) -> DataFrame:
    """Put the instruction positions in front of attention, codec mask, labels and code matrix.

    ``as_text`` names those that ``assemble_sequences`` made as text.
    """
    width = F.size(instruct_mask)
    zeros = ",".join(["0"] * K.CODEBOOKS)
    texts = {
        "attention_mask": F.concat(F.array_join(F.col(instruct_mask).cast("array<int>").cast("array<string>"), ""), F.col("attention_mask")),
        "codec_mask": F.concat(F.repeat(F.lit("0"), width), F.col("codec_mask")),
        "labels": F.concat(F.repeat(F.lit(f"{K.LABEL_IGNORE},"), width), F.col("labels")),
        "code_matrix": F.concat(F.repeat(F.lit(f"{zeros};"), width), F.col("code_matrix")),
    }
    arrays = {
        "attention_mask": F.concat(F.col(instruct_mask), F.col("attention_mask")),
        "codec_mask": A.prefix("codec_mask", width, F.lit(False)),
        "labels": A.prefix("labels", width, A._int(K.LABEL_IGNORE)),
        "code_matrix": A.prefix("code_matrix", width, A.ints(*[0] * K.CODEBOOKS)),
    }
    return df.withColumns({k: texts[k] if k in as_text else v for k, v in arrays.items()})


def shift_for_prediction(df: DataFrame, inputs: list[str], labels: list[str], as_text: bool = False) -> DataFrame:
    """Inputs without their last value, labels without their first; ``as_text`` takes and gives values joined by commas."""
    first, last = (A.shift_inputs_text, A.shift_labels_text) if as_text else (A.shift_inputs, A.shift_labels)
    return df.withColumns({**{c: first(c) for c in inputs}, **{c: last(c) for c in labels}})


def masked_frame_gather(df: DataFrame, seq: str, mask: str, codes: str) -> DataFrame:
    """One row per masked position: sequence id, position, frame."""
    return df.select(seq, F.explode(A.masked_frames(mask, codes)).alias("_f")).select(
        seq, F.col("_f")["position"].alias("position"), F.col("_f")["frame"].alias("frame")
    )


def frames_by_offset(df: DataFrame, seq: str, codes: str, offset: Column) -> DataFrame:
    """As ``masked_frame_gather`` where the masked positions are the run of frames from ``offset`` on: nothing is padded."""
    rows = df.select(seq, offset.cast("int").alias("_from"), F.posexplode(codes).alias("_k", "frame"))
    return rows.select(seq, (F.col("_from") + F.col("_k")).alias("position"), "frame")


def subcode_inputs_labels(df: DataFrame, frame: str = "frame", width: int = K.CODEBOOKS) -> DataFrame:
    return df.withColumns({"inputs": F.slice(frame, 1, width - 1), "labels": F.slice(frame, 2, width - 1)})


def context_chunks(df: DataFrame, codes: str, keep: list[str], chunk: int = K.CHUNK_FRAMES, context: int = K.CHUNK_CONTEXT) -> DataFrame:
    """One row per chunk with its frames, left context included."""
    plan = A.chunk_plan(F.size(codes), chunk, context)
    parts = df.select(*keep, F.col(codes).alias("_codes"), F.explode(plan).alias("_p"))
    at = F.col("_p")
    frames = F.slice("_codes", at["from"].cast("int") + 1, (at["end"] - at["from"]).cast("int"))
    return parts.select(*keep, at["start"].alias("start"), at["end"].alias("end"), at["context"].alias("context"), frames.alias("frames"))
