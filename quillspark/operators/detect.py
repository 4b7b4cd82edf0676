"""Which document type a text is: TF-IDF cosine first, keyword rules where that is not clear."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.portions import in_portions
from ..functions.text import keyword_form, keyword_form_of, keyword_forms, strip_ws
from ..sources.versions import load_version

# Weights, thresholds, boilerplate lines and the built-in rules.
STRONG, WEAK, EXCLUDE = 3.0, 1.0, -10.0
THRESHOLD, LEAST_SCORE, LEAST_MARGIN, MOST_TERMS = 0.25, 0.10, 1.03, 8000
BOILERPLATE = (
    "cộng hòa xã hội chủ nghĩa việt nam", "socialist republic of viet nam", "độc lập - tự do - hạnh phúc",
    "independence - freedom - happiness", "độc lập tự do hạnh phúc",
)
BUILT_IN_RULES = {
    "cccd": {"strong": ["căn cước công dân", "can cuoc cong dan"], "weak": ["số", "quốc tịch", "giới tính", "nơi thường trú"]},
    "giay_ra_vien": {"strong": ["giấy ra viện", "giay ra vien"], "weak": ["bệnh viện", "khoa", "vào viện", "ra viện", "chẩn đoán", "phương pháp điều trị"]},
    "giay_khai_sinh": {"strong": ["giấy khai sinh", "giay khai sinh"], "weak": ["họ và tên", "ngày sinh", "nơi sinh", "họ và tên cha", "họ và tên mẹ"]},
    "gplx": {"strong": ["giấy phép lái xe", "giay phep lai xe"], "weak": ["hạng", "ngày cấp", "có giá trị đến", "quốc tịch"]},
    "vehicle_registration": {"strong": ["đăng ký xe", "giấy đăng ký xe", "dang ky xe"], "weak": ["biển số", "số máy", "số khung", "chủ xe", "nhãn hiệu"]},
}
SCORES = T.ArrayType(T.StructType([T.StructField("ord", T.LongType()), T.StructField("doc_type", T.StringType()), T.StructField("score", T.DoubleType())]))
WORD = r"[\p{L}\p{N}_]{2,}"


def template_keywords(templates: DataFrame) -> DataFrame:
    """doc_type, template_idx, line_no, kind, keyword of (doc_type, template_idx, body)."""
    lines = templates.select("doc_type", "template_idx", F.posexplode(F.split("body", "\n", -1)).alias("line_no", "raw")).withColumn("line", strip_ws(F.col("raw")))
    weak = F.lower(strip_ws(F.regexp_replace(F.substring_index("line", "{{", 1), r"[\s:/\-]+\z", "")))
    strong = F.lower(F.col("line"))
    has = F.contains("line", F.lit("{{"))
    rows = lines.withColumn("kind", F.when(has, "weak").otherwise("strong")).withColumn("keyword", F.when(has, weak).otherwise(strong))
    keep = F.when(has, F.length("keyword") >= 3).otherwise((F.length("keyword") >= 4) & ~F.col("keyword").isin(*BOILERPLATE))
    return rows.where(keep).select("doc_type", F.col("template_idx").cast("long").alias("template_idx"), F.col("line_no").cast("long").alias("line_no"), "kind", "keyword")


def build_rules(templates: DataFrame) -> DataFrame:
    """doc_type, kind, keyword, ord: strong and weak without repeats in order of appearance; exclude holds
    every other type's strong keywords, repeats between types included."""
    found = template_keywords(templates).groupBy("doc_type", "kind", "keyword").agg(F.min(F.struct("template_idx", "line_no")).alias("first"))
    own = found.select("doc_type", "kind", "keyword", (F.row_number().over(Window.partitionBy("doc_type", "kind").orderBy("first", "keyword")) - 1).cast("long").alias("ord"))
    strong = own.where("kind = 'strong'").select(F.col("doc_type").alias("other"), "keyword", "ord")
    types = own.select("doc_type").distinct()  # one row per document type: the product of the two stays small
    exclude = types.crossJoin(strong).where("doc_type <> other")
    order = Window.partitionBy("doc_type").orderBy("other", "ord")
    return own.unionByName(exclude.select("doc_type", F.lit("exclude").alias("kind"), "keyword", (F.row_number().over(order) - 1).cast("long").alias("ord")))


def schema_rules(fields: DataFrame) -> DataFrame:
    """doc_type, kind, keyword, ord where only schemas (doc_type, ord, field) are known: field names as weak keywords."""
    return fields.select("doc_type", F.lit("weak").alias("kind"), F.replace("field", F.lit("_"), F.lit(" ")).alias("keyword"), F.col("ord").cast("long").alias("ord"))


def load_detector(spark: SparkSession, templates: tuple[DataFrame, DataFrame] | None = None, stores: list[str] = (), schemas: DataFrame | None = None) -> tuple[str, dict[str, dict[str, list[str]]], DataFrame | None]:
    """(origin, rules, index) of a detector, from the first source that holds one.

    Templates with their schemas' fields are first: rules and index are built from them. Then the
    newest version of each store in turn (tables ``rules`` and ``index``, of which one is enough),
    checked against its manifest. Then schemas alone, which give weak rules and no index; then the
    rules built in. A source that is there and empty counts as none.
    """
    if templates is not None and not templates[0].isEmpty():
        bodies, fields = templates
        return "templates", rules_of(build_rules(bodies)), tfidf_index(template_corpus(bodies, fields))
    for root in stores:
        found = load_version(spark, root)
        if found:
            number, tables = found
            rules = rules_of(tables["rules"]) if "rules" in tables else {}
            if rules or "index" in tables:
                return f"version {number}", rules, tables.get("index")
    if schemas is not None and not schemas.isEmpty():
        return "schemas", rules_of(schema_rules(schemas)), None
    return "built-in", BUILT_IN_RULES, None


def template_corpus(templates: DataFrame, fields: DataFrame) -> DataFrame:
    """doc_type, corpus: the bodies with placeholders as words, and the schema's field names three times."""
    words = F.regexp_replace("body", r"\{\{\s*([A-Za-z0-9_.()]+)\s*\}\}", " $1 ")
    bodies = templates.groupBy("doc_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("template_idx", F.replace(words, F.lit("_"), F.lit(" ")).alias("b")))), lambda x: x["b"]), " ").alias("body"))
    names = fields.groupBy("doc_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "field"))), lambda x: F.replace(x["field"], F.lit("_"), F.lit(" "))), " ").alias("names"))
    return bodies.join(names, "doc_type", "left").select("doc_type", F.trim(F.regexp_replace(F.concat_ws(" ", "body", "names", "names", "names"), r"\s+", " ")).alias("corpus"))


def term_rows(corpora: DataFrame, key: str, text: str, bigrams: bool = True) -> DataFrame:
    """key, term of every occurrence: words of two or more letters, digits or underscores in lower case, and their bigrams.

    The words stay in one array per text; nothing is sorted or windowed over rows.
    """
    words = corpora.select(key, F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)).alias("w"))
    both = F.concat("w", F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))) if bigrams else F.col("w")
    return words.select(key, F.explode(both).alias("term"))


def tfidf_index(corpora: DataFrame, key: str = "doc_type", text: str = "corpus", most_terms: int = MOST_TERMS) -> DataFrame:
    """key, term, weight, idf: (1 + ln n) * (ln((1 + N) / (1 + df)) + 1), rows of length 1; the most frequent terms only.

    A key's corpus may come as many rows: their terms are counted together, bigrams do not go from one row to the next.
    """
    corpora = corpora.where(F.col(key).isNotNull())
    keys = [r[0] for r in corpora.select(key).distinct().orderBy(key).collect()]  # one per document type: few
    # a term's counts stay on one row, so that the texts are read, counted and dealt once
    counts = term_rows(corpora, key, text).groupBy("term").agg(F.count("*").alias("all"), *(F.count_if(F.col(key) == F.lit(k)).alias(f"n{i}") for i, k in enumerate(keys)))
    top = counts.orderBy(F.desc("all"), "term").limit(most_terms)
    kind = corpora.schema[key].dataType.simpleString()
    found = F.filter(F.array(*(F.struct(F.lit(k).cast(kind).alias(key), F.col(f"n{i}").alias("n")) for i, k in enumerate(keys))) if keys else F.lit(None).cast(f"array<struct<{key}:{kind},n:bigint>>"), lambda x: x["n"] > 0)
    idf = top.select("term", (F.log((1 + F.lit(len(keys))) / (1 + F.size(found))) + 1).alias("idf"), F.inline(found))
    weighted = idf.withColumn("raw", (1 + F.log("n")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", (F.col("raw") / norm).alias("weight"), "idf")


def tfidf_scores(texts: DataFrame, key: str, text: str, index: DataFrame, doc_type: str = "doc_type") -> DataFrame:
    """key, doc_type, score: the cosine of a text's white-space words (lower case) with every indexed type that shares one."""
    words = texts.select(key, F.explode(F.filter(F.split(F.lower(text), r"\s+", -1), lambda w: w != "")).alias("term"))
    by_term = index.groupBy("term").agg(F.first("idf").alias("idf"), F.collect_list(F.struct(F.col(doc_type).alias("doc_type"), "weight")).alias("in"))
    # dealt by key alone: counting, products and norms then need no further exchange
    query = words.repartition(key).groupBy(key, "term").agg(F.count("*").alias("n")).join(F.broadcast(by_term), "term").withColumn("q", (1 + F.log("n")) * F.col("idf"))
    # the text itself goes as one more type, without a name: its product with itself is the squared norm
    own = F.array(F.struct(F.lit(None).cast("string").alias("doc_type"), F.col("q").alias("weight")))
    dots = query.select(key, "q", F.inline(F.concat("in", own))).groupBy(key, "doc_type").agg(F.sum(F.col("q") * F.col("weight")).alias("dot"))
    norm = F.sqrt(F.max(F.when(F.col("doc_type").isNull(), F.col("dot"))).over(Window.partitionBy(key)))
    return dots.withColumn("norm", norm).where("doc_type IS NOT NULL").select(key, "doc_type", (F.col("dot") / F.col("norm")).alias("score"))


def keyword_score_lists(texts: pa.Array, rules: dict[str, dict[str, list[str]]]) -> pa.Array:
    """``keyword_score_array`` of many texts at once."""
    norm = keyword_forms(texts)
    scores = np.zeros((len(texts), len(rules)))
    for i, kinds in enumerate(rules.values()):
        for kind, weight in (("strong", STRONG), ("weak", WEAK), ("exclude", EXCLUDE)):
            for word in kinds.get(kind, []):
                scores[:, i] += weight * np.asarray(pc.fill_null(pc.match_substring(norm, keyword_form_of(word)), False))
    n = len(texts)
    rows = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(len(rules)), n), pa.int64()), pa.array(list(rules) * n, pa.string()), pa.array(np.maximum(scores, 0.0).ravel())], names=SCORES.elementType.names)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(rules)), rows)


def keyword_score_array(text: Column, rules: dict[str, dict[str, list[str]]]) -> Column:
    """(ord, doc_type, score) of every type: 3, 1 and -10 per strong, weak and exclude keyword inside the text, at least 0.

    The rules go to the tasks; texts never meet a rule table in a join.
    """
    return in_portions(lambda t: keyword_score_lists(t, rules), SCORES)(text)


def keyword_scores(texts: DataFrame, key: str, text: str, rules: dict[str, dict[str, list[str]]]) -> DataFrame:
    """key, ord, doc_type, score of every type."""
    return texts.select(key, F.inline(keyword_score_array(F.col(text), rules)))


def share_columns(rows: DataFrame, key: str, scores: str) -> DataFrame:
    """key, total, best (first of equals), its share, all shares rounded to 4 places, first and second score, from an array of scores."""
    listed = F.array_sort(F.transform(scores, lambda x: F.struct((-x["score"]).alias("neg"), x["ord"].alias("ord"), x["doc_type"].alias("doc_type"))))
    out = rows.select(key, listed.alias("s"), F.aggregate(scores, F.lit(0.0), lambda t, x: t + x["score"]).alias("total"))
    share = lambda x: F.round(-x["neg"] / F.col("total"), 4)
    every = F.map_from_entries(F.transform("s", lambda x: F.struct(x["doc_type"], F.when(F.col("total") > 0, share(x)).otherwise(F.lit(0.0)))))
    return out.select(key, "total", F.col("s")[0]["doc_type"].alias("best"), F.when(F.col("total") > 0, share(F.col("s")[0])).otherwise(0.0).alias("share"), every.alias("scores"), (-F.col("s")[0]["neg"]).alias("first"), (-F.get("s", F.lit(1))["neg"]).alias("second"))


def shares(scores: DataFrame, key: str) -> DataFrame:
    """The same from rows (key, ord, doc_type, score), few for each text."""
    return share_columns(scores.groupBy(key).agg(F.collect_list(F.struct("ord", "doc_type", "score")).alias("__scores")), key, "__scores")


def detect_by_keywords(texts: DataFrame, key: str, text: str, rules: dict[str, dict[str, list[str]]] = BUILT_IN_RULES, threshold: float = THRESHOLD) -> DataFrame:
    """key, doc_type (null below the threshold), confidence, is_confident, method keyword or none, scores: one projection."""
    s = share_columns(texts.select(key, keyword_score_array(F.col(text), rules).alias("__scores")), key, "__scores")
    sure = (F.col("total") > 0) & (F.col("share") >= threshold)
    return s.select(key, F.when(sure, F.col("best")).alias("doc_type"), F.col("share").alias("confidence"), sure.alias("is_confident"), F.when(F.col("total") > 0, "keyword").otherwise("none").alias("method"), "scores")


def detect(texts: DataFrame, key: str, text: str, index: DataFrame | None, rules: dict[str, dict[str, list[str]]] = BUILT_IN_RULES, threshold: float = THRESHOLD) -> DataFrame:
    """The TF-IDF decision where the best score is high and clear enough, the keyword decision elsewhere."""
    if index is None:
        return detect_by_keywords(texts, key, text, rules, threshold)
    s = shares(tfidf_scores(texts, key, text, index).withColumn("ord", F.lit(0)).withColumn("score", F.greatest("score", F.lit(0.0))), key)
    second = F.coalesce("second", F.lit(0.0))
    clear = s.where((F.col("first") >= LEAST_SCORE) & ~((second > 0) & (F.col("first") / (second + 1e-9) < LEAST_MARGIN)))
    sure = F.col("share") >= threshold
    by_terms = clear.select(key, F.struct(F.when(sure, F.col("best")).alias("doc_type"), F.col("share").alias("confidence"), sure.alias("is_confident"), F.lit("tfidf").alias("method"), "scores").alias("by_terms"))
    # the index is computed once: the keyword decision, one projection, is made for all texts and used where nothing is clear
    found = detect_by_keywords(texts, key, text, rules, threshold).join(by_terms, key, "left")
    return found.select(key, *(F.when(F.col("by_terms").isNotNull(), F.col(f"by_terms.{c}")).otherwise(F.col(c)).alias(c) for c in ("doc_type", "confidence", "is_confident", "method", "scores")))


def top_n(scores: DataFrame, key: str, n: int) -> DataFrame:
    """The n best (doc_type, share) per text."""
    total = Window.partitionBy(key)
    rows = scores.withColumn("share", F.when(F.sum("score").over(total) > 0, F.round(F.col("score") / F.sum("score").over(total), 4)).otherwise(0.0))
    order = Window.partitionBy(key).orderBy(F.desc("share"), "ord")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n).select(key, "rank", "doc_type", "share")


def explain(texts: DataFrame, key: str, text: str, rules: dict[str, dict[str, list[str]]] = BUILT_IN_RULES) -> DataFrame:
    """key, doc_type, kind, matched: keywords as written (not normalised) found in the normalised text."""
    norm = texts.select(key, keyword_form(F.col(text)).alias("norm"))
    rows = [F.struct(F.lit(t).alias("doc_type"), F.lit(k).alias("kind"), F.filter(F.array(*map(F.lit, words)), lambda w: F.contains("norm", w)).alias("matched")) for t, kinds in rules.items() for k, words in kinds.items() if words]
    return norm.select(key, F.inline(F.array(*rows)))


def register(rules: dict[str, dict[str, list[str]]], doc_type: str, strong: list[str], weak: list[str] = ()) -> dict[str, dict[str, list[str]]]:
    """The rules with one more type; its strong keywords and the others' exclude each other."""
    out = {t: {**kinds, "exclude": [*kinds.get("exclude", []), *strong]} for t, kinds in rules.items() if t != doc_type}
    others = [w for t, kinds in rules.items() if t != doc_type for w in kinds.get("strong", [])]
    return out | {doc_type: {"strong": list(strong), "weak": list(weak), "exclude": others}}


def nearest(batches: Iterator[pa.RecordBatch], ids: np.ndarray, q: np.ndarray, k: int, queries: int = 256, vectors: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k vectors of highest inner product for every query, over batches of (id, v); -inf where there are fewer.

    At most ``queries`` times ``vectors`` products exist at once.
    """
    best, who = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows if len(ids) else 0, vectors):
            part = batch.slice(at, vectors)
            own = np.asarray(part.column("id"))
            x = np.asarray(part.column("v").flatten()).reshape(len(own), -1)
            for low in range(0, len(ids), queries):
                s = slice(low, low + queries)
                scores = np.round(q[s] @ x.T, 6)
                scores[ids[s, None] == own[None, :]] = -np.inf
                every, names = np.hstack((best[s], scores)), np.hstack((who[s], np.broadcast_to(own, scores.shape)))
                order = np.lexsort((names, -every), axis=1)[:, :k]
                best[s], who[s] = np.take_along_axis(every, order, 1), np.take_along_axis(names, order, 1)
    return best, who


def cosine_neighbours(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", block_rows: int = 4096) -> DataFrame:
    """query_id, rank, key, score: the k vectors of highest inner product per query.

    Queries (a stated set) go in blocks of ``block_rows`` to the vectors, which stay where they are;
    a task keeps k rows per query over all its batches, and those are cut to the k best. Scores are
    rounded to 6 places, ties go to the smaller key. Null vectors and null keys take no part.
    """
    some = lambda df: df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows, asked = some(vectors), some(queries)
    blocks = max(1, -(-asked.count() // block_rows))
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        shared = vectors.sparkSession.sparkContext.broadcast((np.array([r.id for r in block], np.int64), np.array([r.v for r in block], np.float64)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            best, who = nearest(batches, ids, q, k)
            keep = np.isfinite(best)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, keep.sum(axis=1))), pa.array(who[keep]), pa.array(best[keep])], names=["query_id", key, "score"])

        found = rows.mapInArrow(run, f"query_id long, {key} long, score double")
        out = found if out is None else out.union(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return out.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k).select("query_id", "rank", key, "score")


def rules_frame(spark: SparkSession, rules: dict[str, dict[str, list[str]]]) -> DataFrame:
    """Rules as rows (doc_type, kind, keyword, ord), to write and read back."""
    return spark.createDataFrame([(t, k, w, i) for t, kinds in rules.items() for k, words in kinds.items() for i, w in enumerate(words)], "doc_type string, kind string, keyword string, ord int")


def rules_of(frame: DataFrame) -> dict[str, dict[str, list[str]]]:
    """The rules of such rows; rule tables are small by nature."""
    out: dict[str, dict[str, list[str]]] = {}
    for r in frame.orderBy("doc_type", "kind", "ord").collect():
        out.setdefault(r.doc_type, {}).setdefault(r.kind, []).append(r.keyword)
    return out
