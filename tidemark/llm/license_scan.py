"""License scans by diagonal voting over word k-grams, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import ascii_lower, dealt_out, placed, whole_row
from tidemark.llm.notices import NOTICES

#: What separates words, and the phrases of the base labels.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def grams(words: Column, k: int) -> Column:
    """Hash of the k words from each position on (fewer at the end)."""
    return F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, k))))


def templates(spark: SparkSession, notices: list[tuple[str, str]], k: int) -> DataFrame:
    """(template, label, grams, words, at, gram, hash): a row per k-gram of each notice; as many as the fixed list has."""
    listed = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(notices)))
    rows = spark.range(1).select(F.explode(listed).alias("r")).select("r.*")
    words = rows.select("template", "label", words_of(F.col("text")).alias("w"))
    words = words.withColumn("grams", F.size("w") - (k - 1)).where("grams > 0")
    at = words.select("template", "label", "grams", F.size("w").alias("words"), "w", F.posexplode(grams(F.col("w"), k)).alias("at", "hash")).where("at < grams")
    return at.select("template", "label", "grams", "words", "at", "hash", F.slice("w", F.col("at") + 1, k).alias("gram"))


def _base(words: Column, phrases: dict[str, str]) -> Column:
    """(at, label) of every place where a phrase's words stand one after the other."""

    def label(w: Column, i: Column) -> Column:
        out = None
        for phrase, name in phrases.items():
            first, *rest = phrase.split(" ")
            fits = w == first
            for j, other in enumerate(rest, 1):
                fits = fits & (F.get(words, i + j) == other)
            out = F.when(fits, F.struct(i.alias("at"), F.lit(name).alias("label"))) if out is None else out.when(fits, F.struct(i.alias("at"), F.lit(name).alias("label")))
        return out

    return F.filter(F.transform(words, label), lambda x: x.isNotNull())


def scan(
    docs: DataFrame, text_col: str = "text", phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str]] = NOTICES,
    k: int = 3, near: int = 2, least: float = 0.6,
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans). documents: place, the columns of docs in ``row``, n_words, base (places and labels of phrases).
    spans: place, template, label, first, last (words of the text), coverage: the verified notices.

    Every k-gram of every text is hashed where the text is read, and those that
    have the hash of a notice's k-gram become rows (with their words alone, so a text
    costs in proportion to its length), which are joined to the notices
    (broadcast: a fixed list of some thousand rows), equal hashes are checked on
    the words themselves, and hits vote for their diagonal, text position minus
    notice position. Diagonals at most ``near`` apart merge; a merged span stands
    if at least ``least`` of the notice's k-grams hit it in the notice's order, each
    further on in the notice than the hit before it, and it is at most twice
    as long as the notice. Votes are combined where they are cast.

    Null texts count as empty and have no words; shorter texts than k have no
    k-grams; repeated rows and null ids are judged row by row (the key is the
    row's place in its file); an empty table gives empty results.
    """
    told = placed(docs.select(whole_row(docs, but=text_col).alias("row"), F.col(text_col).alias("text")), "place")
    told = dealt_out(told)
    words = words_of(F.col("text"))
    has_phrase_word = F.lit(False)
    for phrase in phrases:
        has_phrase_word = has_phrase_word | F.array_contains("words", phrase.split(" ")[-1])
    split = told.select("place", "row", words.alias("words"))
    none = F.array().cast("array<struct<at:int,label:string>>")
    documents = split.select("place", "row", F.size("words").cast("long").alias("n_words"), F.when(has_phrase_word, _base(F.col("words"), phrases)).otherwise(none).alias("base"))

    table = templates(docs.sparkSession, notices, k)
    listed = sorted(r["hash"] for r in table.select("hash").distinct().collect())  # as many as the fixed list has
    # the words pass through a generator, or the optimizer would put the split of the whole text into what is done for each word
    rolled = told.select("place", F.explode(F.array(words)).alias("words")).select("place", "words", grams(F.col("words"), k).alias("hashes"))
    known = F.filter(F.transform("hashes", lambda h, i: F.when(h.isin(listed), F.struct(i.alias("pos"), h.alias("hash")))), lambda x: x.isNotNull())
    few = rolled.select("place", "words", known.alias("known"))
    few = few.select("place", F.inline(F.transform("known", lambda x: F.struct(x["pos"].alias("pos"), x["hash"].alias("hash"), F.slice("words", x["pos"] + 1, k).alias("gram")))))
    hits = few.alias("d").join(F.broadcast(table).alias("t"), (F.col("d.hash") == F.col("t.hash")) & (F.col("d.gram") == F.col("t.gram")))
    votes = (
        hits.groupBy("place", "template", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("at"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.first("label").alias("label"), F.first("grams").alias("grams"), F.first("t.words").alias("size"))
    )
    ordered = W.partitionBy("place", "template").orderBy("diagonal")
    starts = (F.col("diagonal") - F.lag("diagonal").over(ordered) > near).cast("int")
    runs = votes.withColumn("starts", F.coalesce(starts, F.lit(0))).withColumn("run", F.sum("starts").over(ordered))
    placed_hits = F.transform("at", lambda a: F.struct((a + F.col("diagonal")).alias("pos"), a.alias("at")))
    merged = runs.groupBy("place", "template", "run").agg(
        F.first("label").alias("label"), F.min("first").alias("first"), (F.max("last") + k - 1).alias("last"), F.sort_array(F.flatten(F.collect_list(placed_hits))).alias("hits"),
        F.first("grams").alias("grams"), F.first("size").alias("size"),
    )
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("n"))
    in_order = F.aggregate("hits", start, lambda seen, h: F.struct(h["at"].alias("last"), (seen["n"] + (h["at"] > seen["last"]).cast("int")).alias("n")), lambda seen: seen["n"])
    different = F.size(F.array_distinct(F.transform("hits", lambda h: h["at"])))
    spans = merged.withColumn("coverage", F.least(different, in_order) / F.col("grams"))
    spans = spans.where((F.col("coverage") >= least) & (F.col("last") - F.col("first") + 1 <= 2 * F.col("size")))
    return documents, spans.select("place", "template", "label", "first", "last", "coverage")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: 1 where a phrase stands, else the greatest coverage of a verified notice, else 0."""
    documents, spans = scan(docs.select(id_col, text_col), text_col)
    own = spans.groupBy("place").agg(F.collect_set("label").alias("own"), F.max("coverage").alias("coverage"))
    at, label = F.transform("base", lambda b: b["at"]), F.array_distinct(F.transform("base", lambda b: b["label"]))
    joined = lambda a: F.array_join(F.array_sort(a), ",")
    return documents.join(own, "place", "left").select(
        F.col(f"row.{id_col}").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        joined(label).alias("base_labels"), joined(F.array_union(label, F.coalesce("own", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )
