"""How far the sources of a language are from each other and from the language, term by term, counted in shards by DuckDB."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, dealt_out

#: What terms are made of, byte by byte: letters of ASCII, lower-cased, and all that isn't ASCII; everything else parts them.
TERM_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Texts are cut into terms so many bytes at a time.
AT_ONCE = 4 << 20

#: Sums of one shard: a row for each source of each term that enough documents of the language hold, and one, without a source, for all of them.
COUNTS = """
WITH c AS MATERIALIZED (SELECT lang, term, source, sum(n) AS n, sum(docs) AS docs FROM rows GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {least})
SELECT lang, term, source, CAST(n AS BIGINT) AS n FROM c SEMI JOIN k USING (lang, term)
UNION ALL SELECT lang, term, NULL, CAST(n AS BIGINT) FROM k
"""

#: Shares in parts of {scale}, of what was counted and of what wasn't.
_SHARES = """
g AS (SELECT lang, source, n AS total, terms, shard, CASE WHEN terms > 0 THEN 1 + CAST({scale}::HUGEINT * {add} // (n + {add} * terms) AS BIGINT) END AS none
      FROM rows WHERE term IS NULL),
t AS (SELECT r.lang, r.term, r.source, 1 + CAST({scale}::HUGEINT * (r.n + {add}) // (g.total + {add} * g.terms) AS BIGINT) AS p, g.none
      FROM rows r JOIN g ON r.lang = g.lang AND r.source IS NOT DISTINCT FROM g.source WHERE r.term IS NOT NULL)
"""

#: Of one shard: partial sums of |p - q| for each two sources (in one direction), and the terms that may be among a source's first {ranks}.
#: The sum over all terms is that of two sources without any of them, and what each term that a source has changes in it.
SUMS = (
    "WITH"
    + _SHARES.rstrip()
    + """,
n AS (SELECT lang, count(*) AS terms FROM rows WHERE term IS NOT NULL AND source IS NULL GROUP BY ALL),
s AS (SELECT * FROM t WHERE source IS NOT NULL),
pairs AS (SELECT a.lang, a.source AS a, b.source AS b, a.shard, a.none AS a_none, b.none AS b_none, abs(a.none - b.none) AS apart
          FROM g a JOIN g b ON a.lang = b.lang AND a.source < b.source),
part AS (
  SELECT lang, a, b, 0 AS value FROM pairs WHERE shard = 0
  UNION ALL SELECT p.lang, p.a, p.b, n.terms::HUGEINT * p.apart FROM pairs p JOIN n USING (lang)
  UNION ALL SELECT p.lang, p.a, p.b, sum(abs(s.p - p.b_none) - p.apart) FROM s JOIN pairs p ON s.lang = p.lang AND s.source = p.a GROUP BY ALL
  UNION ALL SELECT p.lang, p.a, p.b, sum(abs(s.p - p.a_none) - p.apart) FROM s JOIN pairs p ON s.lang = p.lang AND s.source = p.b GROUP BY ALL
  UNION ALL SELECT x.lang, x.source, y.source, sum(abs(x.p - y.p) - abs(x.p - y.none) - abs(x.none - y.p) + abs(x.none - y.none))
            FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source < y.source GROUP BY ALL
),
terms AS (
  SELECT x.lang, x.source, x.term, x.p - y.p AS value FROM s x JOIN t y ON x.lang = y.lang AND x.term = y.term AND y.source IS NULL WHERE x.p > y.p
  QUALIFY row_number() OVER (PARTITION BY x.lang, x.source ORDER BY x.p - y.p DESC, x.term) <= {ranks}
)
SELECT lang, a AS source, 'pair' AS part, b AS item, CAST(sum(value) AS BIGINT) AS value FROM part GROUP BY ALL
UNION ALL SELECT lang, source, 'term', term, value FROM terms
"""
)




def pieces(text: bytes, most: int = AT_ONCE) -> Iterator[bytes]:
    """A text, cut where terms end into parts of about ``most`` bytes, as far as there are such places."""
    begin = 0
    while len(text) - begin > most:
        end = begin + most
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:] if begin else text


def occurrences(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) from (lang, source, text): how often, and in how many rows, each term stands, summed up
    over as many rows as have ``most`` different ones."""
    one = 1 << 40  # a row; below it the occurrences in a window
    found: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in found.items():
            values = list(terms.values())
            columns = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(list(terms), pa.binary()).cast(pa.string())]
            columns += [pa.array([v % one for v in values], pa.int64()), pa.array([v // one for v in values], pa.int64())]
            table = pa.Table.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            yield from table.to_batches(max_chunksize=50_000)

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            own: Counter = Counter()
            for part in pieces(text or b""):
                own.update(part.translate(TERM_BYTES).split())
            terms = found[(lang, source)]
            held -= len(terms)
            for term, n in own.items():
                terms[term] = terms.get(term, 0) + n + one
            held += len(terms)
            if held >= most:
                yield from flush()
                found.clear()
                held = 0
    yield from flush()


def in_duckdb(batches: Iterator[pa.RecordBatch], query: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A query over the table ``rows`` that one shard's batches make up."""
    import duckdb

    first = next(batches, None)
    if first is None:
        return
    with duckdb.connect(config={"threads": 1, "temp_directory": "", "preserve_insertion_order": False}) as con:
        con.register("incoming", pa.RecordBatchReader.from_batches(first.schema, (b for part in ([first], batches) for b in part)))
        con.execute("CREATE TEMP TABLE rows AS FROM incoming")
        for batch in con.sql(query).to_arrow_reader(50_000):
            yield batch.cast(schema)


def divergence(docs: DataFrame, least: int = 30, add: int = 5, scale: int = 1_000_000_000, ranks: int = 50, shards: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) for each source of each language, in two parts.

    Every language has the terms that stand in ``least`` of its rows or more. A source's share of each, in parts of
    ``scale``, is that of its occurrences among those of all these terms, ``add`` (1 at least) more for each term; the language's
    likewise. Part "pair": each other source of the language, by the sum of the differences of their shares over all
    terms. Part "term": the ``ranks`` terms whose share is furthest above the language's, of those that the source has.
    Greatest values first, then the smaller item, byte by byte. All arithmetic is on integers of up to 128 bits.

    Texts are counted where they are read, and the sums meet in shards by the hash of language and term (as many as the
    session's shuffle partitions by default), so neither a frequent term nor a large source is in one task's hands with
    more than a row for each window of texts and source. In each shard DuckDB counts, and again, once all totals are
    known, adds up differences; Spark adds up and ranks what the shards say. Every shard gets a row for each source;
    what it returns has one for each two of a language, as the result does.

    Null texts, languages and sources count as ''. Rows without an id, or equal ones, are rows like others. A source
    without terms, or a language without any that are frequent enough, has its pairs (in the latter case all 0). An
    empty table gives no rows. Only the columns lang, source and text are read, whatever else is there.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "divergence")
    values = {"least": least, "add": add, "scale": scale, "ranks": ranks}
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [(c, pa.string()) for c in ("lang", "term", "source")]
        return in_duckdb(batches, COUNTS.format(**values), pa.schema([*names, ("n", pa.int64())]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [(c, pa.string()) for c in ("lang", "source", "part", "item")]
        return in_duckdb(batches, SUMS.format(**values), pa.schema([*names, ("value", pa.int64())]))

    seen = dealt_out(docs.select(*named, "text")).mapInArrow(occurrences, "lang string, source string, term string, n long, docs long")
    sharded = seen.select("*", shard).repartitionById(shards, F.col("shard"))
    kept = scratch.write(sharded.mapInArrow(counts, "lang string, term string, source string, n long"), "counts")

    langs = kept.where("source IS NULL").groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms"))
    own = kept.where("source IS NOT NULL").groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sources = docs.select(*named).distinct().join(own, ["lang", "source"], "left").join(langs.select("lang", "terms"), "lang", "left")
    totals = sources.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("terms", F.lit(0)).alias("terms"))
    totals = scratch.write(totals.unionByName(langs.withColumn("source", F.lit(None).cast("string"))), "totals")

    everywhere = totals.withColumn("term", F.lit(None).cast("string")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = kept.select("*", F.lit(None).cast("long").alias("terms"), shard).unionByName(everywhere).repartitionById(shards, F.col("shard"))
    parts = scratch.write(rows.mapInArrow(sums, "lang string, source string, part string, item string, value long"), "sums")

    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", "part", "value", sides.alias("side")).select("lang", "side.source", "part", "side.item", "value")
    ranked = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    terms = parts.where("part = 'term'").select("lang", "source", "part", "item", "value", ranked).where(F.col("rank") <= ranks)
    return pairs.select("lang", "source", "part", "item", "value", ranked).unionByName(terms)
