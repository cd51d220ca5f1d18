"""Registered queries: full-text, vector and hybrid search."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions import text as X
from seekframe.functions import vectors as V
from seekframe.operators import gramindex as GR
from seekframe.operators import vectorindex as VI
from seekframe.operators.search import page, search
from seekframe.operators.textindex import by_id, find, vocabulary
from seekframe.operators.topk import ranked
from seekframe.plans import frames as T
from seekframe.plans import keys as K
from seekframe.plans.catalog import query
from seekframe.plans.query import Cond, Group, Query, Sort, VectorQuery

TOK = "list_filter(regexp_split_to_array(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"
D_TOK, P_TOK = TOK.format("text"), TOK.format("p_name")
VEC = "[" + ", ".join(f"{x!r}::DOUBLE" for x in T.VECTOR) + "]"
COS = f"list_dot_product(embedding::DOUBLE[], {VEC}) / nullif(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product({VEC}, {VEC})), 0)"


def _tf(word: str, toks: str = "tok") -> str:
    return f"len(list_filter({toks}, lambda t: t = '{word}'))::DOUBLE"


def _sat(tf: str) -> str:
    return f"({tf} / ({tf} + 1))"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _docs(spark: SparkSession, d: str, **asked: Any) -> DataFrame:
    """Rows of a search over the documents' text index; of the fields only n_chars is shown, so no text is read."""
    q = Query(**{"fields": ("n_chars",)} | asked)
    return search(T.docs(spark, d, *([q.config] if q.keys is not None else []), vector=q.vector is not None), T.DOCS, q).rows


def _found(spark: SparkSession, d: str, node: K.Node) -> DataFrame:
    return find(T.text_index(spark, d, "documents", T.DOCS), T.DOCS, node)


@query(f"SELECT doc_id, lang, round({_sat(_tf('license'))}, 6) AS score FROM (SELECT doc_id, lang, {D_TOK} AS tok FROM documents) WHERE list_contains(tok, 'license') AND lang = 'en' ORDER BY {_sat(_tf('license'))} DESC, doc_id LIMIT 20")
def search_basic(spark: SparkSession, d: str) -> DataFrame:
    """Keywords, a language, relevance, a page: the basic search."""
    asked = Query(keys="license", languages=("en",), limit=20, fields=("n_chars",))
    return _rounded(ranked(T.docs(spark, d, "simple"), T.DOCS, asked).select("doc_id", "lang", "score"), "score")


@query(f"SELECT doc_id, round(({_sat(_tf('the'))} + {_sat(_tf('de'))}) / 2, 6) AS score FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE list_has_any(tok, ['the', 'de']) ORDER BY ({_sat(_tf('the'))} + {_sat(_tf('de'))}) / 2 DESC, doc_id LIMIT 10")
def ranked_common(spark: SparkSession, d: str) -> DataFrame:
    """The best of two very common words: the ranking stops after the high frequencies."""
    asked = Query(keys={"#conjunction": "OR", "0": "the", "1": "de"}, limit=10, fields=("n_chars",))
    return _rounded(ranked(T.docs(spark, d, "simple"), T.DOCS, asked).select("doc_id", "score"), "score")


@query(f"SELECT doc_id FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE list_contains(tok, 'license') AND list_contains(tok, 'version')")
def fts_and(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d, keys="license version").select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE list_has_any(tok, ['mit', 'apache'])")
def fts_or(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d, keys={"#conjunction": "OR", "0": "mit", "1": "apache"}).select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE list_contains(tok, 'license') AND (list_contains(tok, 'apache') OR (list_contains(tok, 'gnu') AND list_contains(tok, 'version')))")
def fts_boolean(spark: SparkSession, d: str) -> DataFrame:
    keys = {"#conjunction": "AND", "0": "license", "1": {"#conjunction": "OR", "0": "apache", "1": {"0": "gnu", "1": "version"}}}
    return _docs(spark, d, keys=keys).select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, ' ' || array_to_string({D_TOK}, ' ') || ' ' AS t, {D_TOK} AS tok FROM documents) WHERE (contains(t, ' apache license ') OR contains(t, ' mit license ')) AND list_contains(tok, 'the')")
def fts_phrase(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d, keys='"apache license" "mit license" the').select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE len(list_filter(tok, lambda t: starts_with(t, 'licens'))) > 0 AND len(list_filter(tok, lambda t: starts_with(t, 'un'))) > 0")
def fts_prefix(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, K.parse("licens un", prefixes=True)).select(F.col("id").alias("doc_id"))


@query()
def fts_stem(spark: SparkSession, d: str) -> DataFrame:
    """English stems on both sides: forms of a word match each other. Stems have no SQL; tests hold them to known ones."""
    return _docs(spark, d, keys="licensing works", config="english").select("doc_id")


@query()
def fts_stem_language(spark: SparkSession, d: str) -> DataFrame:
    """Each document's tokens are stemmed by its own language; here those in Spanish are searched. Tests hold stems to known ones."""
    return _docs(spark, d, keys="mente", config="language", languages=("es",)).select("doc_id", "lang")


@query(f"SELECT p_partkey FROM part WHERE list_contains({P_TOK}, 'red') OR list_contains({TOK.format('p_type')}, 'economy')")
def fts_multi_field(spark: SparkSession, d: str) -> DataFrame:
    """A row matches if any text field does by itself: each with keys of its own."""
    built = T.text_index(spark, d, "part", T.PARTS_TEXT)
    name, kind = (find(built, T.PARTS_TEXT, K.parse(keys), [field]) for keys, field in (("red", "p_name"), ("economy", "p_type")))
    return by_id(name.union(kind).select("id")).distinct().select(F.col("id").alias("p_partkey"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%WIDG%'")
def fts_ilike_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A part of a word in any case of letters: candidates from trigram postings, verified on their texts."""
    maybe = GR.ilike(T.gram_index(spark, d, "part", T.PARTS_TEXT, "p_name"), "%WIDG%")
    rows = T.table(spark, d, "part").join(maybe.withColumnRenamed("id", "p_partkey"), "p_partkey", "left_semi")
    return rows.where(F.col("p_name").ilike("%WIDG%")).select("p_partkey", "p_name")


@query(f"SELECT doc_id, round(({_sat(_tf('license'))} + {_sat(_tf('version'))}) / 2, 6) AS score FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE list_contains(tok, 'license') AND list_contains(tok, 'version')")
def fts_rank(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_docs(spark, d, keys="license version").select("doc_id", "score"), "score")


@query(f"SELECT doc_id, n_chars, round(({_sat(_tf('license'))} + {_sat(_tf('version'))}) / 2, 6) AS score FROM (SELECT doc_id, n_chars, {D_TOK} AS tok FROM documents) WHERE list_has_any(tok, ['license', 'version']) ORDER BY score DESC, doc_id LIMIT 30 OFFSET 10")
def sort_relevance(spark: SparkSession, d: str) -> DataFrame:
    """The second page of a search in order of relevance, then of id."""
    asked = Query(keys={"#conjunction": "OR", "0": "license", "1": "version"}, sorts=(Sort("relevance", "DESC"),), limit=30, offset=10, fields=("n_chars",))
    found = ranked(T.docs(spark, d, "simple"), T.DOCS, asked)
    return _rounded(found.select("doc_id", "n_chars", "score"), "score")


@query(f"SELECT doc_id, round({_sat(_tf('the'))} / greatest(len(tok), 1), 6) AS by_length, round({_sat(_tf('the'))} / (1 + ln(greatest(len(list_distinct(tok)), 1))), 6) AS by_distinct FROM (SELECT doc_id, {D_TOK} AS tok FROM documents) WHERE list_contains(tok, 'the')")
def fts_rank_norm(spark: SparkSession, d: str) -> DataFrame:
    built = T.text_index(spark, d, "documents", T.DOCS)
    rows = find(built, T.DOCS, K.parse("the")).join(built.lengths, "id")
    by = lambda code: F.round(X.normalised(F.col("text_rank"), F.col("length"), F.col("distinct"), code), 6)
    return rows.select(F.col("id").alias("doc_id"), by(2).alias("by_length"), by(16).alias("by_distinct"))


@query(f"SELECT p_partkey, round(1.0::DOUBLE * {_sat(_tf('red', 'a'))} + 0.4::DOUBLE * {_sat(_tf('red', 'b'))} + 0.2::DOUBLE * {_sat(_tf('red', 'c'))}, 6) AS score FROM (SELECT p_partkey, {P_TOK} AS a, {TOK.format('p_brand')} AS b, {TOK.format('p_type')} AS c FROM part) WHERE list_contains(a, 'red')")
def fts_weighted(spark: SparkSession, d: str) -> DataFrame:
    built = T.text_index(spark, d, "part", T.PARTS_TEXT)
    named, ranked = find(built, T.PARTS_TEXT, K.parse("red"), ["p_name"]).select("id"), find(built, T.PARTS_TEXT, K.parse("red"))
    return ranked.join(named, "id").select(F.col("id").alias("p_partkey"), F.round("text_rank", 6).alias("score"))


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '')"
_BARE = "regexp_replace(lower(w), '[^\\p{L}\\p{N}]', '', 'g')"


@query(f"""SELECT doc_id, array_to_string(list_transform(list_slice(ws, greatest(first - 8, 1), greatest(first - 8, 1) + 34), lambda w: CASE WHEN {_BARE} = 'license' THEN '<strong>' || w || '</strong>' ELSE w END), ' ') AS excerpt
FROM (SELECT doc_id, ws, list_position(list_transform(ws, lambda w: {_BARE}), 'license') AS first FROM (SELECT doc_id, {_WORDS} AS ws FROM documents)) WHERE first > 0""")
def highlight(spark: SparkSession, d: str) -> DataFrame:
    """Excerpts of the documents that match: only their texts are looked at."""
    found = _found(spark, d, K.parse("license")).select(F.col("id").alias("doc_id"))
    return T.table(spark, d, "documents").join(found, "doc_id", "left_semi").select("doc_id", X.highlight(F.col("text"), K.parse("license")).alias("excerpt")).where("excerpt IS NOT NULL")


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')) AS body FROM pages")
def text_normalise(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "pages").select("page_id", X.normalise(F.col("html")).alias("body"))


@query(r"SELECT doc_id, array_to_string(list_filter(string_split(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')), ' '), lambda w: length(w) >= 3 AND length(w) <= 40), ' ') AS body FROM documents")
def text_word_length(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select("doc_id", X.keep_word_lengths(F.col("text")).alias("body"))


@query("SELECT doc_id, strlen(coalesce(text, '')) <= 1000000 AS fits, true AS utf8 FROM documents")
def text_validation(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return T.table(spark, d, "documents").select("doc_id", (F.octet_length(text) <= X.MAX_TEXT).alias("fits"), F.is_valid_utf8(text).alias("utf8"))


_TRI = "list_distinct(list_transform(range(1, length('  ' || lower({0}) || ' ') - 1), lambda i: substring('  ' || lower({0}) || ' ', i::BIGINT, 3)))"


@query(f"SELECT p_partkey, p_name, round(shared::DOUBLE / (la + lb - shared), 6) AS similarity FROM (SELECT p_partkey, p_name, len(list_intersect(a, b)) AS shared, len(a) AS la, len(b) AS lb FROM (SELECT p_partkey, p_name, {_TRI.format('p_name')} AS a, {_TRI.format(chr(39) + 'red wigdet' + chr(39))} AS b FROM part)) WHERE shared::DOUBLE / (la + lb - shared) >= 0.3")
def fuzzy_trigram(spark: SparkSession, d: str) -> DataFrame:
    """Names like a misspelling; likeness follows from the postings of its trigrams, names are only shown."""
    found = GR.similar(T.gram_index(spark, d, "part", T.PARTS_TEXT, "p_name"), "red wigdet", 0.3)
    return T.table(spark, d, "part").join(found.withColumnRenamed("id", "p_partkey"), "p_partkey").select("p_partkey", "p_name", F.round("similarity", 6).alias("similarity"))


@query(f"SELECT vec_id, round({COS}, 6) AS similarity FROM embeddings")
def vector_cosine(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "embeddings").select("vec_id", F.round(V.cosine(F.col("embedding"), V.literal(T.VECTOR)), 6).alias("similarity"))


@query(f"SELECT vec_id, round(list_distance(embedding::DOUBLE[], {VEC}), 6) AS distance FROM embeddings")
def vector_l2(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "embeddings").select("vec_id", F.round(V.l2(F.col("embedding"), V.literal(T.VECTOR)), 6).alias("distance"))


@query(f"SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], {VEC}), 6) AS product FROM embeddings")
def vector_inner_product(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "embeddings").select("vec_id", F.round(V.dot(F.col("embedding"), V.literal(T.VECTOR)), 6).alias("product"))


@query(f"SELECT doc_id, lang, round(sim, 6) AS score FROM (SELECT d.doc_id, d.lang, {COS} AS sim FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id) WHERE sim >= 0.05 AND lang IN ('en', 'fr') ORDER BY sim DESC, doc_id LIMIT 50")
def vector_search(spark: SparkSession, d: str) -> DataFrame:
    found = _docs(spark, d, mode="vector_only", vector=VectorQuery(T.VECTOR, threshold=0.05), languages=("en", "fr"), limit=50)
    return _rounded(found.select("doc_id", "lang", "score"), "score")


@query(f"SELECT doc_id FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id WHERE lang = 'en' AND ({COS} >= 0.1 OR n_chars < 100)")
def filter_similar(spark: SparkSession, d: str) -> DataFrame:
    """Likeness as a condition among others."""
    where = Group((Cond("lang", "en"), Cond("content_embedding", op="IS NOT NULL"), Group((Cond("content_embedding", (T.VECTOR, 0.1), "SIMILAR"), Cond("n_chars", 100, "<")), "OR")))
    return _docs(spark, d, where=where).select("doc_id")


_HYBRID = f"""SELECT doc_id, has, hit, tf / (tf + 1) AS rank, sim FROM (
  SELECT d.doc_id, e.embedding IS NOT NULL AS has, list_contains({D_TOK}, 'license') AS hit, {_tf('license', D_TOK)} AS tf, {COS} AS sim
  FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id) WHERE hit OR coalesce(sim >= 0.1, false)"""


@query(f"""SELECT doc_id, round(CASE WHEN sim IS NOT NULL AND hit THEN greatest(0.6 * rank, 0.001) + greatest(0.4 * sim, 0.001) WHEN sim IS NOT NULL THEN greatest(0.4 * sim, 0.001) WHEN hit THEN greatest(0.6 * rank, 0.001) ELSE 0.001 END, 6) AS score,
round(CASE WHEN hit THEN rank ELSE 0 END, 6)::DOUBLE AS text_score, round(coalesce(sim, 0), 6) AS vector_score FROM ({_HYBRID})""")
def hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    found = _docs(spark, d, keys="license", vector=VectorQuery(T.VECTOR, threshold=0.1))
    return _rounded(found.select("doc_id", "score", "text_score", "vector_score"), "score", "text_score", "vector_score")


@query(f"SELECT doc_id, round(0.6 * CASE WHEN hit THEN rank ELSE 0 END + 0.4 * sim, 6)::DOUBLE AS score FROM ({_HYBRID})")
def hybrid_plain(spark: SparkSession, d: str) -> DataFrame:
    """The plain weighted sum, without a score where there is no vector."""
    found = _docs(spark, d, keys="license", vector=VectorQuery(T.VECTOR, threshold=0.1, guarded=False))
    return _rounded(found.select("doc_id", "score"), "score")


@query(f"SELECT count(*) AS result_count FROM ({_HYBRID})")
def hybrid_count(spark: SparkSession, d: str) -> DataFrame:
    """The count has the same predicate as the rows: text or vector."""
    return search(T.docs(spark, d, "simple", vector=True), T.DOCS, Query(keys="license", vector=VectorQuery(T.VECTOR, threshold=0.1), limit=3)).count


@query()
def vector_ann(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest neighbours of every twentieth vector among all, from the vector index; tests measure its recall."""
    rows = T.table(spark, d, "embeddings")
    found = VI.search(T.vector_index(spark, d), rows.where("vec_id % 20 = 0"), "vec_id", "embedding")
    return found.select("query_id", F.col("id").alias("vec_id"), F.round("similarity", 6).alias("similarity"))


@query("SELECT vec_id, len(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AS valid FROM embeddings")
def vector_validate(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "embeddings").select("vec_id", V.is_valid(F.col("embedding"), 64).alias("valid"))


@query("SELECT event_id, round(value + 1, 6) AS second, event_id % 3 <> 0 AS parsed FROM events")
def vector_parse(spark: SparkSession, d: str) -> DataFrame:
    """Texts as [a, b]; every third has a component that is no number."""
    bad = F.when(F.col("event_id") % 3 == 0, "x").otherwise("1")
    texts = T.table(spark, d, "events").select("event_id", "value", F.concat(F.lit("[ "), bad, F.lit(", "), (F.col("value") + 1).cast("string"), F.lit("]")).alias("t"))
    parsed = V.parse(F.col("t"))
    again = V.parse(F.regexp_replace("t", "x", "0"))
    return texts.select("event_id", F.round(again[1], 6).alias("second"), parsed.isNotNull().alias("parsed"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS length FROM embeddings")
def vector_normalise(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "embeddings").select("vec_id", F.round(V.norm(V.normalise(F.col("embedding"))), 6).alias("length"))


@query("SELECT count(*) AS total, count(e.vec_id) AS with_embedding, round(100.0::DOUBLE * count(e.vec_id) / count(*), 6) AS percent FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id")
def embedding_coverage(spark: SparkSession, d: str) -> DataFrame:
    has = F.count_if(F.col("content_embedding").isNotNull())
    total = F.count(F.lit(1))
    source = T.docs(spark, d)
    return source.attach(source.base, ("content_embedding",), "doc_id").agg(total.alias("total"), has.alias("with_embedding"), F.round(F.try_divide(has * 100.0, total), 6).alias("percent"))


@query(f"SELECT token, n FROM (SELECT unnest({D_TOK}) AS token FROM documents) SELECT token, count(*) AS n WHERE starts_with(token, 'lic') GROUP BY token ORDER BY n DESC, token LIMIT 10".replace("SELECT token, n FROM (", "FROM ("))
def autocomplete(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent tokens with a prefix; an extension."""
    tokens = vocabulary(T.text_index(spark, d, "documents", T.DOCS)).where(F.col("token").startswith("lic"))
    return page(tokens, [F.desc("n"), F.asc("token")], 10, 0)


@query("SELECT b.vec_id, round(list_cosine_similarity(b.embedding::DOUBLE[], a.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id = 0 AND b.vec_id <> 0 ORDER BY list_cosine_similarity(b.embedding::DOUBLE[], a.embedding::DOUBLE[]) DESC, b.vec_id LIMIT 10")
def more_like_this(spark: SparkSession, d: str) -> DataFrame:
    """The nearest neighbours of one item; an extension. Lists of the vector index are looked at until no other can matter."""
    rows = T.table(spark, d, "embeddings")
    one = rows.where("vec_id = 0").select("embedding").first()
    near = VI.nearest(T.vector_index(spark, d), tuple(one.embedding or ()) if one else (), 10, lambda found: found.where("id <> 0"))
    return near.select(F.col("id").alias("vec_id"), F.round("similarity", 6).alias("similarity"))


@query(f"SELECT token, levenshtein(token, 'licence') AS distance, n FROM (SELECT token, count(*) AS n FROM (SELECT unnest({D_TOK}) AS token FROM documents) GROUP BY token) WHERE levenshtein(token, 'licence') <= 2 ORDER BY distance, n DESC, token LIMIT 5")
def spellcheck(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary's words nearest to a misspelling; an extension. Lengths are compared before letters."""
    words = vocabulary(T.text_index(spark, d, "documents", T.DOCS)).where(F.abs(F.char_length("token") - 7) <= 2)
    found = words.withColumn("distance", F.levenshtein("token", F.lit("licence"))).where("distance <= 2")
    return page(found.select("token", "distance", "n"), [F.asc("distance"), F.desc("n"), F.asc("token")], 5, 0)
