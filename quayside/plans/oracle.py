"""DuckDB SQL twins of the registered queries (the correctness oracle)."""

from __future__ import annotations

from quayside.functions.schemas import SALES_EVENT_SCHEMA

_DUCK_TYPES = {
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR",
    "TimestampType()": "TIMESTAMP",
}

# lineitem column -> sales event column, in DuckDB SQL
_LINEITEM_SQL = {
    "cs_order_number": "CAST(l_orderkey AS INTEGER)",
    "cs_item_sk": "CAST(l_partkey AS INTEGER)",
    "cs_quantity": "CAST(l_quantity AS INTEGER)",
    "cs_ext_sales_price": "l_extendedprice",
    "cs_ext_discount_amt": "l_extendedprice * l_discount",
    "cs_ext_tax": "l_extendedprice * l_tax",
    "session_id": "'s' || CAST(l_suppkey AS VARCHAR)",
    "CreatedTime": "l_shipdate",
}


def sales_event_columns(absent: tuple[str, ...] = (), null_when: str | None = None) -> str:
    """Select list of the 36 event fields projected from lineitem.

    ``absent`` fields are null (an older schema version lacks them); ``null_when``
    makes the whole record null under a condition (an undecodable message).
    """
    out = []
    for f in SALES_EVENT_SCHEMA.fields:
        duck = _DUCK_TYPES[repr(f.dataType)]
        expr = _LINEITEM_SQL.get(f.name)
        if expr is None or f.name in absent:
            expr = "NULL"
        if null_when and expr != "NULL":
            expr = f"CASE WHEN {null_when} THEN NULL ELSE {expr} END"
        out.append(f'CAST({expr} AS {duck}) AS "{f.name}"')
    return ",\n  ".join(out)


def sales_events_sql(where: str | None = None, **kw) -> str:
    sql = f"SELECT\n  {sales_event_columns(**kw)}\nFROM lineitem"
    return sql + (f"\nWHERE {where}" if where else "")


# ---------------------------------------------------------------------------
# clean_text in RE2 syntax (same rule as quayside.functions.text.clean_text)
# ---------------------------------------------------------------------------
_BLANKS_RE2 = r"[ \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean_text_sql(expr: str) -> str:
    no_ctl = f"regexp_replace(coalesce({expr}, ''), '[\\x00-\\x1f\\x7f-\\x9f]', '', 'g')"
    no_colon = f"regexp_replace({no_ctl}, ':', ' -', 'g')"
    return f"regexp_replace({no_colon}, '\\A{_BLANKS_RE2}|{_BLANKS_RE2}\\z', '', 'g')"


DOCS_SQL = "SELECT CAST(doc_id AS VARCHAR) AS id, source AS fileName, text FROM documents"
CHECKPOINT_SQL = "SELECT CAST(doc_id AS VARCHAR) AS id FROM labels"


PENDING_SQL = (
    f"SELECT d.* FROM ({DOCS_SQL}) d WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({CHECKPOINT_SQL}) c WHERE c.id = d.id)"
)


def batches_sql(size: int = 16, where: str = "") -> str:
    return f"""SELECT *, CAST(rn // {size} AS BIGINT) AS batch_id, CAST(rn % {size} AS INTEGER) AS batch_pos
FROM (SELECT *, CAST(row_number() OVER (ORDER BY id NULLS FIRST) - 1 AS BIGINT) AS rn FROM ({PENDING_SQL}){where})"""


def outcome_sql(size: int = 16, reject: str = "@mail") -> str:
    """Batch fails when any text in it is rejected; the first rejected text's message wins."""
    return f"""WITH b AS (
  SELECT *, CASE WHEN text IS NULL OR text = '' THEN 'empty input'
                 WHEN contains(text, '{reject}') THEN 'input is rejected' END AS bad
  FROM ({batches_sql(size, " WHERE id IS NOT NULL")})
), f AS (
  SELECT batch_id, arg_min(bad, rn) AS error FROM b WHERE bad IS NOT NULL GROUP BY batch_id
)
SELECT b.id, b.fileName, b.text, b.batch_id,
       CASE WHEN f.error IS NULL THEN 'success' ELSE 'failed' END AS status, f.error
FROM b LEFT JOIN f USING (batch_id)
UNION ALL SELECT id, fileName, text, NULL, 'failed', 'document without an id' FROM ({DOCS_SQL}) WHERE id IS NULL"""


def index_vectors_sql(dim: int) -> str:
    """Vectors of successful documents: word tokens hashed by crc32 into ``dim`` signed places, to unit length."""
    byte = "CAST('0x' || substr(hex(t), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT)"
    codes = f"list_transform(range(1, strlen(t) + 1), lambda i: {byte})"
    zeros = ", ".join(["0"] * 8)
    bits = f"list_reduce([xor(a, b), {zeros}], lambda u, z: CASE WHEN u % 2 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {bits}), 4294967295)"
    return f"""WITH o AS (SELECT id, fileName, text FROM ({outcome_sql()}) WHERE status = 'success'),
w AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]+')) AS t FROM o),
h AS (SELECT t, {crc} AS h FROM (SELECT DISTINCT t FROM w)),
p AS (SELECT id, h % {dim} AS place, sum(CASE WHEN h >> 31 = 1 THEN -1 ELSE 1 END) AS v FROM w JOIN h USING (t) GROUP BY ALL),
n AS (SELECT id, sqrt(sum(v * v)) AS norm FROM p GROUP BY id)
SELECT o.id, {clean_text_sql('o.text')} AS content, o.fileName, CAST(r.place AS INTEGER) AS place,
  round(CAST(CAST(CASE WHEN coalesce(norm, 0) > 0 THEN coalesce(v, 0) / norm ELSE 0 END AS FLOAT) AS DOUBLE), 6) AS value
FROM o CROSS JOIN range({dim}) AS r(place) LEFT JOIN n ON n.id = o.id LEFT JOIN p ON p.id = o.id AND p.place = r.place"""


def _unit(v: str) -> str:
    return f"list_transform({v}, lambda y: y / sqrt(list_sum(list_transform({v}, lambda z: z * z))))"


def vector_topk_sql(k: int = 10) -> str:
    return f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(generate_series(1, len(v))) AS i, unnest(v) AS x FROM e),
m AS (SELECT label AS qid, i, avg(x) AS m FROM x GROUP BY label, i),
c AS (SELECT qid, list(m ORDER BY i) AS c FROM m GROUP BY qid),
q AS (SELECT qid, {_unit('c')} AS qv FROM c),
u AS (SELECT vec_id, {_unit('v')} AS uv FROM e),
s AS (SELECT q.qid, u.vec_id, list_dot_product(u.uv, q.qv) AS score FROM u, q)
SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s
) WHERE rank <= {k}"""


def _tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({expr}, '')), '[^\\pL\\pN]+'), lambda t: t <> '')"


def bm25_sql(k: int = 10, k1: float = 1.2, b: float = 0.75) -> str:
    return f"""WITH d AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         list_concat({_tokens(clean_text_sql('text'))}, {_tokens('source')}) AS toks
  FROM documents),
dl AS (SELECT id, len(toks) AS dl FROM d),
stats AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avgdl FROM dl),
q AS (SELECT DISTINCT qid, term FROM (SELECT item_id AS qid, unnest({_tokens('text')}) AS term FROM benchmark)),
p AS (SELECT id, unnest(toks) AS term FROM d),
tf AS (SELECT id, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (
  SELECT q.qid, tf.id,
         sum(ln(1 + (stats.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * ({k1} + 1.0)
             / (tf.tf + {k1} * ({1.0 - b} + {b} * dl.dl / stats.avgdl))) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (id) CROSS JOIN stats
  GROUP BY q.qid, tf.id)
SELECT qid, id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM s
) WHERE rank <= {k}"""
