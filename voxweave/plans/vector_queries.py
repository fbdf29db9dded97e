"""Vector quantisation over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as N
from ..operators import ordering as O
from ..operators import quantize as Z
from . import inputs as I
from .registry import query

DIM = 64
BOOK = f"{I.VECTORS}, {I.sql_codebook(16)}"


def _round(c, digits=6):
    return F.array_join(F.transform(c, lambda x: F.format_number(F.round(x, digits) + F.lit(0.0), digits)), ",")


def _sql_round(x: str, digits: int = 6) -> str:
    return f"array_to_string(list_transform({x}, lambda _y: printf('%.{digits}f', round(_y, {digits}) + 0.0)), ',')"


def _sql_nearest(rows: str, book: str, name: str, extra: str = "") -> str:
    best = "min({'d': list_sum(list_transform(list_zip(v.vec, b.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': b.code})"
    return f"{name} AS (SELECT v.vec_id, v.vec{extra}, {best} AS m FROM {rows} v, {book} b GROUP BY ALL)"


@query(
    "nearest_codeword_join",
    f"WITH {BOOK}, {_sql_nearest('vectors', 'book', 'near')} SELECT vec_id, m.c AS code, round(m.d, 6) AS dist FROM near",
)
def nearest_codeword_join(spark, sf):
    found = Z.nearest_codeword_join(I.vectors(spark, sf), I.codebook(spark, sf, 16))
    return found.select("vec_id", F.col("nearest.code").alias("code"), F.round("nearest.dist", 6).alias("dist"))


@query(
    "codeword_lookup",
    f"""WITH {BOOK}, c AS (SELECT doc_id, unnest({I.sql_codes()}) AS f, generate_subscripts({I.sql_codes()}, 1) - 1 AS t FROM documents)
 SELECT doc_id, t, code, round(vec[1], 6) AS first_value, round(vec[64], 6) AS last_value,
 round(list_sum(list_transform(vec, lambda x, i: x * i)), 4) AS digest FROM c JOIN book ON book.code = c.f[1] % 16""",
)
def codeword_lookup(spark, sf):
    codes = I.code_rows(spark, sf).select("doc_id", F.posexplode("codes").alias("t", "f"))
    codes = codes.select("doc_id", F.col("t").cast("long").alias("t"), (F.col("f")[0] % 16).alias("code"))
    out = Z.codeword_lookup(codes, I.codebook(spark, sf, 16), ["code"])
    return out.select(
        "doc_id", "t", "code", F.round(F.col("vec")[0], 6).alias("first_value"), F.round(F.col("vec")[63], 6).alias("last_value"),
        _digest("vec").alias("digest"),
    )


def _digest(c):
    """All values of a vector in one number: their sum, each times its place."""
    return F.round(F.aggregate(F.transform(c, lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x), 4)


@query("l2_normalize", f"WITH {I.VECTORS} SELECT vec_id, {_sql_round('list_transform(vec, lambda x: (x * 3) / greatest(sqrt(list_sum(list_transform(vec, lambda z: z * z * 9))), 1e-12))')} AS vec FROM vectors")
def l2_normalize(spark, sf):
    rows = I.vectors(spark, sf).select("vec_id", F.transform("vec", lambda x: x * 3).alias("vec"))
    return rows.select("vec_id", _round(N.l2_normalize("vec")).alias("vec"))


@query(
    "codebook_from_sums",
    f"WITH {I.VECTORS} SELECT vec_id, {_sql_round('list_transform(vec, lambda x: x / greatest(vec_id % 4, 1e-5))', 4)} AS vec FROM vectors",
)
def codebook_from_sums(spark, sf):
    return I.vectors(spark, sf).select("vec_id", _plain(N.codebook_from_sums("vec", F.col("vec_id") % 4), 4).alias("vec"))


def _plain(c, digits):
    return F.array_join(F.transform(c, lambda x: F.regexp_replace(F.format_number(F.round(x, digits) + F.lit(0.0), digits), ",", "")), ",")


@query(
    "mean_center_frames",
    f"""WITH {I.VECTORS}, u AS (SELECT vec_id, label, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM vectors),
 m AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY label, i) AS c FROM u)
 SELECT vec_id, array_to_string(list(printf('%.6f', round(c, 6) + 0.0) ORDER BY i), ',') AS centered FROM m GROUP BY vec_id""",
)
def mean_center_frames(spark, sf):
    out = Z.mean_center_frames(I.vectors(spark, sf), "label", "vec", DIM)
    return out.select("vec_id", _round(F.col("centered")).alias("centered"))


@query(
    "weighted_mean_std_pool",
    f"""WITH {I.VECTORS}, w AS (SELECT *, CAST(vec_id % 5 + 1 AS DOUBLE) / sum(vec_id % 5 + 1) OVER (PARTITION BY label) AS w FROM vectors),
 u AS (SELECT label, w, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM w),
 m AS (SELECT *, sum(w * x) OVER (PARTITION BY label, i) AS mu FROM u),
 s AS (SELECT label, i, any_value(mu) AS mu, sqrt(greatest(sum(w * (x - mu) * (x - mu)), 1e-12)) AS sd FROM m GROUP BY label, i)
 SELECT label, array_to_string(list(printf('%.6f', round(mu, 6) + 0.0) ORDER BY i), ',') AS mean, array_to_string(list(printf('%.6f', round(sd, 6) + 0.0) ORDER BY i), ',') AS std FROM s GROUP BY label""",
)
def weighted_mean_std_pool(spark, sf):
    v = I.vectors(spark, sf)
    totals = v.groupBy("label").agg(F.sum(F.col("vec_id") % 5 + 1).alias("total"))
    rows = v.join(totals, "label").withColumn("w", (F.col("vec_id") % 5 + 1).cast("double") / F.col("total"))
    out = Z.weighted_mean_std_pool(rows, "label", "vec", "w", DIM)
    return out.select("label", _round(F.col("mean")).alias("mean"), _round(F.col("std")).alias("std"))


def _kmeans_sql(k: int, rounds: int, seed: int) -> str:
    parts = [
        f"""WITH {I.VECTORS}, m0 AS (SELECT CAST(row_number() OVER (ORDER BY md5(vec_id || ':0:{seed}'), vec_id) - 1 AS INTEGER) AS code, vec
 FROM vectors QUALIFY row_number() OVER (ORDER BY md5(vec_id || ':0:{seed}'), vec_id) <= {k})"""
    ]
    for r in range(rounds):
        parts.append(_sql_nearest("vectors", f"m{r}", f"n{r}"))
        parts.append(
            f"""s{r} AS (SELECT code, list(mu ORDER BY i) AS vec, any_value(n) AS n FROM (SELECT code, i, avg(x) AS mu, count(*) AS n FROM
 (SELECT m.c AS code, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM n{r}) GROUP BY code, i) GROUP BY code)"""
        )
        parts.append(
            f"m{r + 1} AS (SELECT m.code, coalesce(s.vec, m.vec) AS vec, coalesce(s.n, 0) AS members FROM m{r} m LEFT JOIN s{r} s ON s.code = m.code)"
        )
    return ", ".join(parts) + f" SELECT code, members, {_sql_round('vec', 5)} AS vec FROM m{rounds}"


@query("kmeans_fit", _kmeans_sql(12, 3, 1))
def kmeans_fit(spark, sf):
    out = Z.kmeans_fit(I.vectors(spark, sf), 12, 3, seed=1)
    return out.select("code", "members", _round(F.col("vec"), 5).alias("vec"))


def _ema_book(spark, sf):
    book = I.codebook(spark, sf, 16)
    return book.withColumns({"size": (F.col("code") % 5 + 1).cast("double"), "avg": F.col("vec")})


EMA = f"""{BOOK}, {_sql_nearest('vectors', 'book', 'near')}, st AS (SELECT code, vec, CAST(code % 5 + 1 AS DOUBLE) AS size FROM book)"""


@query(
    "ema_codebook_update",
    f"""WITH {EMA}, cnt AS (SELECT m.c AS code, count(*) AS n FROM near GROUP BY m.c),
 sums AS (SELECT m.c AS code, i, sum(x) AS t FROM (SELECT m, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM near) GROUP BY m.c, i),
 sz AS (SELECT st.code, 0.99 * size + (1.0 - 0.99) * coalesce(n, 0) AS size FROM st LEFT JOIN cnt ON cnt.code = st.code),
 av AS (SELECT u.code, u.i, 0.99 * u.x + (1.0 - 0.99) * coalesce(t, 0) AS a FROM (SELECT code, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM st) u LEFT JOIN sums s ON s.code = u.code AND s.i = u.i),
 sm AS (SELECT code, size, (size + 1e-5) / (sum(size) OVER () + 16 * 1e-5) * sum(size) OVER () AS s FROM sz)
 SELECT code, round(any_value(size), 6) AS size, array_to_string(list(printf('%.6f', round(a / s, 6) + 0.0) ORDER BY i), ',') AS vec FROM av JOIN sm USING (code) GROUP BY code""",
)
def ema_codebook_update(spark, sf):
    out = Z.ema_codebook_update(_ema_book(spark, sf), I.vectors(spark, sf))
    return out.select("code", F.round("size", 6).alias("size"), _round(F.col("vec")).alias("vec"))


@query(
    "dead_code_expiry",
    f"""WITH {EMA}, smp AS (SELECT CAST(row_number() OVER (ORDER BY md5(vec_id || ':0:9'), vec_id) - 1 AS INTEGER) AS code, vec AS fresh FROM vectors
 QUALIFY row_number() OVER (ORDER BY md5(vec_id || ':0:9'), vec_id) <= 16),
 e AS (SELECT code, vec, size, size / sum(size) OVER () * 16 < 0.9 AS expired FROM st)
 SELECT code, size, expired, {_sql_round('CASE WHEN expired THEN fresh ELSE vec END')} AS vec FROM e JOIN smp USING (code)""",
)
def dead_code_expiry(spark, sf):
    out = Z.dead_code_expiry(_ema_book(spark, sf), I.vectors(spark, sf), seed=9, threshold=0.9)
    return out.select("code", "size", "expired", _round(F.col("vec")).alias("vec"))


@query(
    "commitment_loss",
    f"WITH {BOOK}, {_sql_nearest('vectors', 'book', 'near')} SELECT round(avg(m.d) / 64 * 0.25, 8) AS loss FROM near",
)
def commitment_loss(spark, sf):
    out = Z.commitment_loss(I.vectors(spark, sf), I.codebook(spark, sf, 16), weight=0.25)
    return out.select(F.round("loss", 8).alias("loss"))


# ---------------------------------------------------------------- residual codes


STAGES, SIZE = 3, 8
ALL_STAGES, SMALL = 16, 4  # decoding uses every code of a frame


def stage_books(spark, sf, dim_from: int = 0, dim: int = DIM, stages: int = STAGES, size: int = SIZE):
    """Codebooks of ``size`` vectors for each stage; later stages are scaled down as residuals are."""
    v = I.vectors(spark, sf).where(F.col("vec_id") < stages * size)
    stage = F.floor(F.col("vec_id") / size).cast("int")
    scale = F.lit(1.0) / (stage + 1)
    return v.select(
        stage.alias("stage"), (F.col("vec_id") % size).cast("int").alias("code"),
        F.transform(F.slice("vec", dim_from + 1, dim), lambda x: x * scale).alias("vec"),
    )


def _sql_books(a: int = 1, b: int = DIM, name: str = "books", stages: int = STAGES, size: int = SIZE) -> str:
    return f"""{name} AS (SELECT CAST(vec_id // {size} AS INTEGER) AS stage, CAST(vec_id % {size} AS INTEGER) AS code,
 list_transform(vec[{a}:{b}], lambda x: x * (CAST(1.0 AS DOUBLE) / (vec_id // {size} + 1))) AS vec FROM vectors WHERE vec_id < {stages * size})"""


def _sql_rvq(a: int, b: int, tag: str) -> str:
    parts = [_sql_books(a, b, f"books{tag}"), f"r{tag}0 AS (SELECT vec_id, vec[{a}:{b}] AS vec, CAST([] AS INTEGER[]) AS codes FROM vectors)"]
    for s in range(STAGES):
        parts.append(f"b{tag}{s} AS (SELECT code, vec FROM books{tag} WHERE stage = {s})")
        parts.append(_sql_nearest(f"r{tag}{s}", f"b{tag}{s}", f"n{tag}{s}", ", v.codes"))
        parts.append(
            f"""r{tag}{s + 1} AS (SELECT n.vec_id, list_transform(list_zip(n.vec, b.vec), lambda p: p[1] - p[2]) AS vec, list_append(n.codes, n.m.c) AS codes
 FROM n{tag}{s} n JOIN b{tag}{s} b ON b.code = n.m.c)"""
        )
    return ", ".join(parts)


@query("rvq_encode", f"WITH {I.VECTORS}, {_sql_rvq(1, DIM, 'x')} SELECT vec_id, {I.sql_show('codes')} AS codes FROM rx{STAGES}")
def rvq_encode(spark, sf):
    out = Z.rvq_encode(I.vectors(spark, sf), stage_books(spark, sf))
    return out.select("vec_id", I.show("codes").alias("codes"))


@query(
    "rvq_decode",
    f"""WITH {I.VECTORS}, {_sql_books(stages=ALL_STAGES, size=SMALL)}, c AS (SELECT doc_id, generate_subscripts({I.sql_codes()}, 1) - 1 AS t, unnest({I.sql_codes()}) AS f FROM documents),
 l AS (SELECT doc_id, t, unnest(range(0, {ALL_STAGES})) AS stage, unnest(f) % {SMALL} AS code FROM c),
 words AS (SELECT stage, code, vec, list_sum(list_transform(vec, lambda x, i: x * i)) AS weighed FROM books),
 d AS (SELECT doc_id, t, vec[1] AS x1, vec[33] AS x33, vec[64] AS x64, weighed FROM l JOIN words USING (stage, code))
 SELECT doc_id, t, round(sum(x33), 6) AS middle_value, round(sum(x1), 6) AS first_value, round(sum(x64), 6) AS last_value, round(sum(weighed), 4) AS digest
 FROM d GROUP BY doc_id, t""",
)
def rvq_decode(spark, sf):
    codes = I.code_rows(spark, sf).select("doc_id", F.posexplode("codes").alias("t", "f"))
    codes = codes.select(
        "doc_id", F.col("t").cast("long").alias("t"), F.transform("f", lambda c: (c % SMALL).cast("int")).alias("codes")
    )
    out = Z.rvq_decode(codes, stage_books(spark, sf, stages=ALL_STAGES, size=SMALL), key=["doc_id", "t"], semantic=1)
    return out.select(
        "doc_id", "t", F.round(F.col("decoded")[32], 6).alias("middle_value"), F.round(F.col("decoded")[0], 6).alias("first_value"),
        F.round(F.col("decoded")[63], 6).alias("last_value"), _digest("decoded").alias("digest"),
    )


@query(
    "grouped_rvq",
    f"""WITH {I.VECTORS}, {_sql_rvq(1, 22, 'a')}, {_sql_rvq(23, 44, 'b')}, {_sql_rvq(45, 64, 'c')}
 SELECT vec_id, {I.sql_show('a.codes')} || ';' || {I.sql_show('b.codes')} || ';' || {I.sql_show('c.codes')} AS codes,
 round(list_sum(list_transform(list_concat(list_concat(a.vec, b.vec), c.vec), lambda x: x * x)), 6) AS residual
 FROM ra{STAGES} a JOIN rb{STAGES} b USING (vec_id) JOIN rc{STAGES} c USING (vec_id)""",
)
def grouped_rvq(spark, sf):
    books = None
    for g, (lo, dim) in enumerate(((0, 22), (22, 22), (44, 20))):
        one = stage_books(spark, sf, lo, dim).withColumn("group", F.lit(g))
        books = one if books is None else books.unionByName(one)
    rows = Z.grouped_rvq_encode(I.vectors(spark, sf), books, DIM, 3)
    back = Z.grouped_rvq_decode(rows, books, 3)
    gap = F.aggregate(F.zip_with("vec", "decoded", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return back.select("vec_id", I.show_rows("codes").alias("codes"), F.round(gap, 6).alias("residual"))
