"""Benchmark decontamination by template canonicalisation, on DataFrame functions only.

A text becomes words, and words become typed placeholders where they carry a value: numbers, measures (a number with a
unit's letters at its end), units, and names (capitalised words that do not begin a sentence). What is left is lower
case without punctuation. Windows of ``WINDOW`` such words are hashed and joined with the benchmark's, so a question
whose numbers, names or units were changed still meets its template. Matched windows of a document and an item are
then checked: the values in the slots of the item must map to the document's by a function (one item value, one document
value) for all but ``MAX_CLASHES`` of them, else the match is by chance. Both are judged over all places of a pair, over
each group of places with near shifts (place in the document less place in the item: one copy, words put in or left out),
and over each single shift, so that copies with other values do not speak against each other. A pair counts as
contaminated if one of these has ``COVERAGE`` of the item's windows and passes; the widest that does is returned.

Items of fewer words than a window have one window of their own length. Windows that are mostly placeholders, and all of
items under ``LEAST_WORDS`` words, are looked for by their values, in lower case and without punctuation around words, so
they are found verbatim only. ``COVERAGE`` is of all windows, or of those with a template alone. Besides, a run of at least
``RUN_WORDS`` of an item's words at one shift, with the same values, is enough: a long excerpt of a longer item.

Rows: null and empty texts have no words and match nothing; a null id is a document or item like any other. Documents
are told apart by id and a hash of the text, so rows of different texts that share an id (or have none) are judged one
by one, and copies of a row are one document; items likewise. Columns other than ids and texts are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxweave.session import cut_lineage

from .native import small

WINDOW = 6
COVERAGE = 0.3
MAX_CLASHES = 0.2
LEAST_WORDS = 4
RUN_WORDS = 50
_DOC, _ITEM = ["doc_id", "_text"], ["item_id", "_wording"]
# Placeholders are private-use characters, which no pattern below takes for letters or punctuation.
NUMBER, MEASURE, UNIT, NAME = "\ue000", "\ue001", "\ue002", "\ue003"
_SLOTS = f"[{NUMBER}{MEASURE}{UNIT}{NAME}]"
_SPACE = r"[\x20\x09-\x0D]"
# Units that stand alone.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonnes ounce ounces pound pounds ml l liter "
    "liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year "
    "years dollar dollars cent cents euro euros percent degrees mph kmh volt volts watt watts joule joules newton newtons"
).split()


def _any_of(options: list[str]) -> str:
    """A pattern of any of these words that looks at each letter once: common beginnings are shared."""
    ends, heads = "" in options, {}
    for word in filter(None, options):
        heads.setdefault(word[0], []).append(word[1:])
    inner = "|".join(letter + _any_of(rest) for letter, rest in heads.items())
    if len(heads) == 1 and not ends:
        return inner
    return f"(?:{inner})" + ("?" if ends else "") if heads else ""


_RULES = (
    # a name is a capitalised word after a lower-case letter, comma or semicolon; then those that follow a name
    (r"([\p{Ll},;]\x20)\p{Lu}\p{Ll}+", f"$1{NAME}"),
    (f"({NAME}\\x20)" + r"\p{Lu}\p{Ll}+", f"$1{NAME}"),
    (r"(^|" + _SPACE + r")[(\[+\-$€£]*[0-9][0-9.,:/%\-]*[)\].,;:!?]*(?=" + _SPACE + "|$)", f"$1{NUMBER}"),
    (r"(^|" + _SPACE + r")[(\[+\-$€£]*[0-9][0-9.,]*\p{L}{1,4}[)\].,;:!?]*(?=" + _SPACE + "|$)", f"$1{MEASURE}"),
    (r"(?i)(^|" + _SPACE + r")" + _any_of(UNITS) + r"[)\].,;:!?]*(?=" + _SPACE + "|$)", f"$1{UNIT}"),
    (r"[^\p{L}\p{N}\x20\x09-\x0D" + NUMBER + MEASURE + UNIT + NAME + "]+", ""),
)
_EMPTY = r"^[^\p{L}\p{N}]*$"


def words(text: Column) -> Column:
    """Canonical words. Every word of the text that has a letter or digit gives one; others give none."""
    for pattern, to in _RULES:
        text = F.regexp_replace(text, pattern, to)
    return F.filter(F.split(F.lower(text), _SPACE + "+"), lambda w: w != "")


def raw_words(text: Column) -> Column:
    """The words behind ``words``, one for one."""
    return F.filter(F.split(text, _SPACE + "+"), lambda w: ~w.rlike(_EMPTY))


def _bare(raw: Column) -> Column:
    return F.lower(F.regexp_replace(raw, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}%]+$", ""))


def _mostly_slots(m: Column, size: int) -> Column:
    """False only if no window of ``size`` marks is more than half placeholders: enough of them stand close together."""
    least = size // 2 + 1
    return m.rlike("1" + f"[01]{{0,{size - least}}}1" * (least - 1))


def _worded(table: DataFrame, sizes: list[int] | None = None) -> DataFrame:
    """``table`` with w, m, b for its text: canonical words, a mark for each (1: placeholder), and bare values.

    With ``sizes``, the values are worked out only for texts in which a window of one of these sizes may need them.
    """
    keys = [c for c in table.columns if c != "text"]
    rows = table.select(*keys, "text", words(F.col("text")).alias("w"))
    rows = rows.select(*keys, "text", "w", F.array_join(F.transform("w", lambda x: F.when(x.isin(NUMBER, MEASURE, UNIT, NAME), "1").otherwise("0")), "").alias("m"))
    some = F.size("w") > 0
    if sizes is not None and min(sizes, default=LEAST_WORDS) >= LEAST_WORDS:
        some = reduce(or_, [_mostly_slots(F.col("m"), size) for size in sizes], F.lit(False))
    return rows.select(*keys, "w", "m", F.when(some, F.transform(raw_words(F.col("text")), _bare)).alias("b"))


def _exact(m: Column, place: Column, size: Column | int) -> Column:
    """Whether a window is looked for by its values."""
    size = F.lit(size) if isinstance(size, int) else size
    return (size < LEAST_WORDS) | (2 * F.length(F.translate(F.substring(m, place + 1, size), "1", "")) < size)


def _windows(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """(keys of ``rows``, size, place, key, exact) of every window of these sizes; places start at 0.

    Places are exploded, not windows: keys are worked out in the generated code that goes on to the join.
    """
    keys = [c for c in rows.columns if c not in ("w", "m", "b")]
    size, place = F.col("size"), F.col("place")
    rows = rows.select("*", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("size")).where(F.size("w") >= size)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("place"))
    exact = F.col("b").isNotNull() & _exact(F.col("m"), place, size)
    valued = F.xxhash64(F.slice("b", place + 1, size), size, F.lit("exact"))
    key = F.when(exact, valued).otherwise(F.xxhash64(F.slice("w", place + 1, size), size))
    return rows.select(*keys, "size", "place", key.alias("key"), exact.alias("exact"))


def _clean(table: DataFrame, key: str, name: str, text_key: str) -> DataFrame:
    """(name, text_key, text) of rows with a text; ``text_key`` is a hash of it."""
    text = F.col("text").cast("string")
    return table.where(F.col("text").isNotNull()).select(F.col(key).cast("long").alias(name), F.xxhash64(text).alias(text_key), text.alias("text"))


def _documents(docs: DataFrame) -> DataFrame:
    return _clean(docs, "doc_id", *_DOC)


def _items(benchmark: DataFrame) -> DataFrame:
    return _clean(benchmark, "item_id", *_ITEM)


def template_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, _text, item_id, _wording, size, place, item_place, exact) of every window of a document that is one of an item.

    Documents are read and put into words once, whatever the sizes of the items.
    """
    items = _worded(_items(benchmark)).where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    items = cut_lineage(items.distinct())
    sizes = sorted(r[0] for r in items.select("n").distinct().collect())
    if not sizes:
        keys = "doc_id long, _text long, item_id long, _wording long"
        return docs.sparkSession.createDataFrame([], f"{keys}, size int, place int, item_place int, exact boolean")
    one = _windows(items, sizes).where(F.col("size") == F.col("n")).select(*_ITEM, "size", F.col("place").alias("item_place"), "key")
    found = _windows(_worded(_documents(docs), sizes), sizes).join(small(one), ["key", "size"])
    return found.select(*_DOC, *_ITEM, "size", "place", "item_place", "exact")


def _slots(table: DataFrame, place: str, value: str) -> DataFrame:
    """(keys of ``table``, place, kind, value) of every placeholder."""
    keys = [c for c in table.columns if c != "text"]
    pairs = F.arrays_zip(words(F.col("text")).alias("w"), raw_words(F.col("text")).alias("r"))
    rows = table.select(*keys, F.posexplode(pairs).alias(place, "p"))
    rows = rows.where(F.col("p.w").rlike(f"^{_SLOTS}$"))
    return rows.select(*keys, place, F.col("p.w").alias("kind"), _bare(F.col("p.r")).alias(value))


def _beside(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", more: Column | None = None) -> DataFrame:
    """Join on keys of which the first may be null on both sides; the right side's keys are dropped."""
    other = right.withColumnsRenamed({c: f"{c}_" for c in keys})
    same = reduce(and_, [F.col(keys[0]).eqNullSafe(F.col(f"{keys[0]}_")), *[F.col(c) == F.col(f"{c}_") for c in keys[1:]]])
    return left.join(other, same if more is None else same & more, how).drop(*[f"{c}_" for c in keys])


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, run_words: int = RUN_WORDS) -> DataFrame:
    """As ``contaminated``, with ``_text``, the hash of the document's text."""
    matches = cut_lineage(template_matches(docs, benchmark, window))
    items = _items(benchmark)
    n_words = _worded(items).select(*_ITEM, "m", F.length("m").alias("n"))
    places = F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))
    templates = F.when(F.col("n") >= window, F.size(F.filter(places, lambda i: ~_exact(F.col("m"), i, window)))).otherwise(F.lit(1))
    n_windows = small(n_words.groupBy(*_ITEM).agg(
        F.max(F.greatest(F.col("n") - window + 1, F.lit(1))).alias("item_windows"), F.max(templates).alias("item_templates")
    ))
    aligned = cut_lineage(_alignments(matches, n_windows, window, run_words))
    parted = [*_DOC, *_ITEM, "part"]
    pairs = aligned.select("*", F.explode("_parts").alias("part")).groupBy(*parted).agg(
        F.countDistinct("item_place").alias("windows"), F.countDistinct(F.when(~F.col("exact"), F.col("item_place"))).alias("templates")
    )
    pairs = _beside(pairs, n_windows, _ITEM)
    most = (F.col("templates") > 0) & (F.col("templates") >= coverage * F.col("item_templates"))
    excerpt = (F.col("part.level") == 3) & (F.col("windows") >= run_words - window + 1)
    pairs = pairs.where((F.col("windows") >= coverage * F.col("item_windows")) | most | excerpt)
    inside = (F.col("slot") >= F.col("item_place")) & (F.col("slot") < F.col("item_place") + F.col("size"))
    inside = _beside(aligned, small(_slots(items, "slot", "item_value")), _ITEM, more=inside)
    inside = inside.select(*_DOC, *_ITEM, "kind", "slot", "item_value", (F.col("slot") + F.col("shift")).alias("at"), F.explode("_parts").alias("part")).distinct()
    inside = cut_lineage(inside)
    wanted = small(inside.select(*_DOC).distinct())
    doc_slots = _slots(_beside(_documents(docs), wanted, _DOC), "at", "doc_value").select(*_DOC, F.col("at").alias("_at"), "doc_value").distinct()
    compared = _beside(inside, doc_slots, _DOC, more=F.col("at") == F.col("_at"))
    values = compared.groupBy(*parted, "kind", "item_value").agg(
        F.countDistinct("doc_value").alias("images"), F.max((F.col("doc_value") != F.col("item_value")).cast("int")).alias("changed")
    )
    slots = values.groupBy(*parted).agg(
        F.count("*").alias("slots"), F.sum((F.col("images") > 1).cast("long")).alias("clashes"), F.max("changed").alias("changed")
    )
    slots = slots.withColumnsRenamed({c: f"{c}_" for c in parted})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in parted])
    rows = pairs.join(slots, same, "left").select(
        *parted, F.col("windows").cast("long").alias("windows"), F.col("item_windows").cast("long").alias("item_windows"),
        F.coalesce("slots", F.lit(0)).cast("long").alias("slots"), F.coalesce("clashes", F.lit(0)).cast("long").alias("clashes"),
        (F.coalesce("changed", F.lit(0)) > 0).alias("reparameterised"),
    )
    passed = rows.where((F.col("clashes") <= MAX_CLASHES * F.col("slots")) & ((F.col("part.level") < 3) | ~F.col("reparameterised")))
    shown = ("windows", "item_windows", "slots", "clashes", "reparameterised")
    order = F.struct(F.col("part.level"), -F.col("windows"), F.col("clashes"), -F.col("slots"), F.col("part.at"))
    best = passed.groupBy(*_DOC, *_ITEM).agg(F.min_by(F.struct(*shown), order).alias("best"))
    return best.select(*_DOC, "item_id", *[f"best.{c}" for c in shown])


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, run_words: int = RUN_WORDS) -> DataFrame:
    """One row a contaminated (document, item): windows matched and in all, slots compared, clashes, and whether values differ."""
    return judged(docs, benchmark, window, coverage, run_words).drop("_text")


def _alignments(matches: DataFrame, n_windows: DataFrame, window: int, run_words: int) -> DataFrame:
    """``matches`` with ``shift`` and ``_parts``, the sets of places that a match is judged in, as (level, at).

    Level 0 is the whole pair, 1 a group of shifts no further apart than half the item, 2 a single shift, 3 a run of
    places of one shift without a gap, as long as ``run_words`` asks for.
    """
    keys = [*_DOC, *_ITEM]
    aligned = matches.select(*keys, (F.col("place") - F.col("item_place")).alias("shift"), "item_place", "size", "exact").distinct()
    pair = Window.partitionBy(*keys)
    order = pair.orderBy("shift")
    far = F.col("shift") - F.lag("shift").over(order) > (F.col("item_windows") + window - 1) / 2
    aligned = _beside(aligned, n_windows, _ITEM).withColumn("_far", F.coalesce(far, F.lit(False)).cast("int"))
    aligned = aligned.withColumn("_group", F.sum("_far").over(order)).withColumn("_one", F.min("shift").over(pair) == F.max("shift").over(pair))
    # windows without a gap share the difference of place and rank
    straight = Window.partitionBy(*keys, "shift")
    aligned = aligned.withColumn("_run", F.col("item_place") - F.dense_rank().over(straight.orderBy("item_place")))
    aligned = aligned.withColumn("_long", F.count(F.lit(1)).over(Window.partitionBy(*keys, "shift", "_run")) >= run_words - window + 1)
    part = lambda level, at: F.struct(F.lit(level).alias("level"), at.cast("long").alias("at"))
    parts = F.when(F.col("_one"), F.array(part(0, F.lit(0)))).otherwise(
        F.array(part(0, F.lit(0)), part(1, F.col("_group")), part(2, F.col("shift")))
    )
    runs = F.when(F.col("_long"), F.array(part(3, F.xxhash64("shift", "_run")))).otherwise(F.array().cast("array<struct<level:int,at:bigint>>"))
    return aligned.select(*keys, "shift", "item_place", "size", "exact", F.concat(parts, runs).alias("_parts"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents, columns as they are; a document is told by its id and text."""
    found = small(judged(docs, benchmark).select(F.col("doc_id").alias("_doc"), F.col("_text").alias("_hash")).distinct())
    text = F.xxhash64(docs["text"].cast("string"))
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_doc"]) & (text == found["_hash"]), "left_anti")
