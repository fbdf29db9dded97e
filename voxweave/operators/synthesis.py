"""Extension points: user callables run over Arrow batches of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.request import urlopen

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as X
from ..functions.batches import text_slices
from ..functions.text import _col

# Words that mark an accelerator running out of memory.
MEMORY_WORDS = ("cuda", "cublas", "cudnn", "hip", "mps")
ALLOC_FAILURES = ("cublas_status_alloc_failed", "cudnn_status_alloc_failed")


def out_of_memory(error: BaseException) -> bool:
    """Whether an error means that the batch was too large."""
    said = str(error).lower()
    if isinstance(error, MemoryError) or any(word in said for word in ALLOC_FAILURES):
        return True
    return "out of memory" in said and any(word in said for word in MEMORY_WORDS)


def bisect_on_error(
    call: Callable[[pd.DataFrame], list], is_resource_error: Callable[[BaseException], bool] = out_of_memory
) -> Callable[[pd.DataFrame], list]:
    """Wrap a batch callable: a batch too large is halved, left part first, down to single rows.

    A single row that still fails gives null in its place. Any other error goes up.
    """

    def guarded(batch: pd.DataFrame) -> list:
        waiting, out = [batch], []
        while waiting:
            part = waiting.pop()
            try:
                out.extend(call(part))
            except BaseException as error:  # noqa: BLE001 - the caller decides what a resource error is
                if not is_resource_error(error):
                    raise
                if len(part) == 1:
                    out.append(None)
                else:
                    half = len(part) // 2
                    waiting += [part.iloc[half:], part.iloc[:half]]
        return out

    return guarded


def batch_map(df: DataFrame, call: Callable[[pd.DataFrame], list], into: str, kind: str, size: int = K.ENCODE_BATCH,
              inputs: list[str] | None = None) -> DataFrame:
    """Add a column computed by a batch callable, ``size`` rows per call.

    The callable sees at most ``size`` rows whatever the Arrow batch size is, and only the ``inputs`` columns. It is
    marked as not deterministic, so a filter on the result stays above it and every row reaches it once.
    """
    wanted = F.struct(*(inputs or df.columns))

    @F.pandas_udf(kind)
    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list = []
            for lo in range(0, len(batch), size):
                out.extend(call(batch.iloc[lo : lo + size]))
            yield pd.Series(out, index=batch.index, dtype=object)

    return df.withColumn(into, mapped.asNondeterministic()(wanted))


def batch_encoder_udf(df: DataFrame, encoder: Callable[[pd.DataFrame], list], into: str = "audio_codes", size: int = K.ENCODE_BATCH,
                      inputs: list[str] | None = None, kind: str = "array<array<int>>") -> DataFrame:
    """Codes for every clip from a user encoder that takes a batch of rows; rows it must drop get null."""
    return batch_map(df, bisect_on_error(encoder), into, kind, size, inputs)


def attach_codes(df: DataFrame, encoder: Callable[[pd.DataFrame], list], **options) -> DataFrame:
    """``batch_encoder_udf`` without the rows the encoder dropped."""
    into = options.get("into", "audio_codes")
    return batch_encoder_udf(df, encoder, **options).where(F.col(into).isNotNull())


def tokenize_udf(tokenizer: Callable[[str], list[int]]) -> Callable[[Column | str], Column]:
    """Column function text -> ids from a user tokenizer, called once per text.

    Ids go into Arrow text by text and leave in parts of about ``batches.SLICE`` bytes of text, so a task holds one part.
    """

    made = F.arrow_udf(_token_ids(tokenizer), "array<int>")
    return lambda c: made(_col(c))


def _token_ids(tokenizer: Callable[[str], list[int]]):
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for first, n in text_slices(column):
                texts, parts, ends = column.slice(first, n), [], [0]
                for text in texts.to_pylist():
                    parts.append(pa.array([] if text is None else list(tokenizer(text)), pa.int32()))
                    ends.append(ends[-1] + len(parts[-1]))
                valid = np.append(np.asarray(texts.is_valid()), True)
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=~valid), pa.concat_arrays(parts))

    return ids


def code_points(text: str) -> list[int]:
    """Stand-in tokenizer: one id per character."""
    return np.frombuffer(text.encode("utf-32-le"), "<u4").tolist()


def build_clone_prompts(clips: DataFrame, speaker_vector: Column, codes: Column, keep: list[str]) -> DataFrame:
    """Stored prompts: no codes in vector-only mode, and ``icl_mode`` is its opposite."""
    only_vector = F.coalesce("x_vector_only_mode", F.lit(False))
    return clips.select(
        *keep,
        F.when(~only_vector, codes).alias("ref_code"),
        speaker_vector.alias("ref_spk_embedding"),
        only_vector.alias("x_vector_only_mode"),
        (~only_vector).alias("icl_mode"),
        F.col("ref_text"),
    )


def batch_synthesis_job(requests: DataFrame, model: Callable[[pd.DataFrame], list], languages: DataFrame,
                        size: int = K.ENCODE_BATCH, inputs: list[str] | None = None) -> DataFrame:
    """Request table to result table (all request columns, codes, error).

    Invalid requests are marked and never reach the model; everything before the model call is column work.
    """
    from .requests import join_language_id

    checked = join_language_id(requests, languages).withColumn("prompt", X.assistant_prompt("text"))
    error = F.when(X.is_blank("text"), "empty text").when(F.col("language_error"), "unsupported language")
    marked = checked.withColumn("error", error).drop("language_error")
    names = inputs or ["prompt", "language_id"]
    live = F.col("error").isNull()

    def run(batch: pd.DataFrame) -> list:
        wanted = batch[batch["_live"]]
        made = iter(bisect_on_error(model)(wanted[names])) if len(wanted) else iter(())
        return [next(made) if alive else None for alive in batch["_live"]]

    done = batch_map(marked.withColumn("_live", live), run, "codes", "array<int>", size, [*names, "_live"])
    failed = F.col("error").isNull() & F.col("codes").isNull()
    return done.withColumn("error", F.when(failed, "out of memory").otherwise(F.col("error"))).drop("_live")


def fetch_files(plan: DataFrame, fetch: Callable[[str], bytes] | None = None, wait: Callable[[float], None] | None = None) -> DataFrame:
    """Fetch every planned URL with its retry delays: (name, path url, content, tries); content is null on failure."""
    import time

    get = fetch or (lambda url: urlopen(url, timeout=30).read())  # noqa: S310
    pause = wait or time.sleep

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, url, attempts, delays in zip(batch["name"], batch["url"], batch["attempts"], batch["delays"]):
                content, tries = None, 0
                while content is None and tries < attempts:
                    tries += 1
                    try:
                        content = get(url)
                    except Exception:  # noqa: BLE001 - a failed fetch is counted, not fatal
                        if tries < attempts:
                            pause(float(delays[tries - 1]))
                rows.append((name, url, content, tries))
            yield pd.DataFrame(rows, columns=["name", "url", "content", "tries"])

    return plan.select("name", "url", "attempts", "delays").mapInPandas(work, "name string, url string, content binary, tries int")
