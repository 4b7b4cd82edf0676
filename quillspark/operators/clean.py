"""Cleaning, deduplicating and validating entities."""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WS, capitalize_words, let, strip_ws, word_count

# Gender spellings, labels that bleed into values, and markers at which free text is cut.
GENDERS = {"NỮ": "Nữ", "NU": "Nữ", "NO": "Nữ", "N0": "Nữ", "NƯ": "Nữ", "NỪ": "Nữ", "NAM": "Nam"}
LEADING_LABELS = (rf"(?iu)^(họ tên(?:/full name)?{WS}*:?){WS}+", rf"(?iu)^(nơi cư trú(?:/address)?{WS}*:?){WS}+", rf"(?iu)^(quê quán{WS}*:?){WS}+", rf"(?iu)^(chẩn đoán{WS}*:?){WS}+")
CLASS_MARKERS = ("hạng/class", "hang/class", "class:", "hạng:")
CUT_MARKERS = (
    "ngày cấp", "date of issue", "ngày hết hạn", "expiration date", "họ tên", "full name", "quốc tịch", "nationality",
    "giới tính", "gender", "quê quán", "nơi thường trú", "số i no.", "citizen identity", "có giá trị đến", "date of expiry",
)
FREE_TEXT = ("ADDRESS", "NOTES", "DIAGNOSIS", "TREATMENT_METHOD", "PLACE_OF_ORIGIN", "PLACE_OF_RESIDENCE")
MERGED = ("ADDRESS", "NOTES", "DIAGNOSIS")
CLASS_VALUE = rf"(?iu)(hạng{WS}*/{WS}*class|hang{WS}*/{WS}*class|class|hạng){WS}*:?{WS}*[,;\-]?{WS}*[A-Z0-9]{{1,3}}(?![\p{{L}}\p{{N}}_])"
NAME_LETTERS = "A-ZÀÁẢÃẠĂẮẶẲẴÂẤẦẨẪẬĐÈÉẸẺẼÊỀẾỆỂỄÌÍỊỈĨÒÓỌỎÕÔỒỐỘỔỖƠỜỚỢỞỠùúụủũưừứựửữỳýỵỷỹ"


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def trim_edges(text: Column) -> Column:
    return F.trim(text, F.lit(" ,.;:-"))


def trim_bleed(etype: Column, text: Column) -> Column:
    """The value without labels of neighbouring fields that line merging ran into it."""
    text = strip_ws(text)
    for pattern in LEADING_LABELS:
        text = F.regexp_replace(text, pattern, "")
    address = F.contains(etype, F.lit("ADDRESS"))

    def mended(t: Column) -> Column:
        return trim_edges(F.regexp_replace(F.regexp_replace(t, CLASS_VALUE, " "), rf"{WS}{{2,}}", " "))

    def cut(t: Column) -> Column:
        # a marker at the very start is no cut; class markers were mended in addresses
        place = lambda low, markers: F.array(*(F.locate(m, low) for m in markers))
        every = let(F.lower(t), lambda low: F.when(address, place(low, CUT_MARKERS)).otherwise(place(low, CLASS_MARKERS + CUT_MARKERS)))
        return let(F.array_min(F.filter(every, lambda p: p > 1)), lambda first: F.when(first.isNotNull(), trim_edges(F.substr(t, F.lit(1), first - 1))).otherwise(t))

    def trimmed(t: Column) -> Column:
        return strip_ws(let(F.when(address, mended(t)).otherwise(t), lambda x: F.when(any_of(etype, FREE_TEXT), cut(x)).otherwise(x)))

    return let(text, trimmed)


def normalize_gender(text: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*map(F.lit, chain(*GENDERS.items()))), F.upper(text)), text)


def clean_value(etype: Column, text: Column) -> Column:
    text = F.when(F.contains(etype, F.lit("GENDER")), normalize_gender(text)).otherwise(text)
    return F.when(F.contains(etype, F.lit("NAME")), capitalize_words(text)).otherwise(text)


def deduplicate(entities: DataFrame, *key: str) -> DataFrame:
    """One entity per type: the first occurrence; address, notes and diagnosis gather the later ones after ", "."""
    rows = entities.withColumn("__trimmed", trim_bleed(F.col("type"), F.col("text")))
    parts = F.array_sort(F.collect_list(F.struct("ord", "__trimmed", "end")))
    first = F.min(F.struct("ord", "start", "end", "confidence"))
    out = rows.groupBy(*key, "type").agg(parts.alias("p"), first.alias("f"))
    merged = any_of(F.col("type"), MERGED)
    head = clean_value(F.col("type"), F.col("p")[0]["__trimmed"])
    text = F.when(merged, F.array_join(F.concat(F.array(head), F.transform(F.slice("p", 2, F.size("p")), lambda x: x["__trimmed"])), ", ")).otherwise(head)
    end = F.when(merged, F.element_at("p", -1)["end"]).otherwise(F.col("f.end"))
    return out.select(*key, F.col("f.ord").alias("ord"), "type", text.alias("text"), F.col("f.start").alias("start"), end.alias("end"), F.col("f.confidence").alias("confidence"))


def first_of_type(etype: str, entities: Column) -> Column:
    """``deduplicate`` for one type: what the array of its entities, in order, comes to; null if it is empty."""
    first = F.get(entities, F.lit(0))
    head = clean_value(F.lit(etype), trim_bleed(F.lit(etype), first["text"]))
    if any(m in etype for m in MERGED):
        later = F.transform(F.slice(entities, 2, F.greatest(F.size(entities), F.lit(1))), lambda x: trim_bleed(F.lit(etype), x["text"]))
        head = F.array_join(F.concat(F.array(head), later), ", ")
        end = F.element_at(entities, -1)["end"]
    else:
        end = first["end"]
    made = F.struct(first["ord"].alias("ord"), F.lit(etype).alias("type"), head.alias("text"), first["start"].alias("start"), end.alias("end"), first["confidence"].alias("confidence"))
    return F.when(F.size(entities) > 0, made)


def first_of_any(etype: Column, entities: Column) -> Column:
    """``first_of_type`` for a type that differs from row to row; the array of its entities is not empty."""
    merged = any_of(etype, MERGED)
    first = F.get(entities, F.lit(0))
    later = F.transform(F.slice(entities, 2, F.size(entities)), lambda x: trim_bleed(etype, x["text"]))
    end = F.when(merged, F.element_at(entities, -1)["end"]).otherwise(first["end"])

    def made(head: Column) -> Column:
        text = F.when(merged, F.array_join(F.concat(F.array(head), later), ", ")).otherwise(head)
        return F.struct(first["ord"].alias("ord"), etype.alias("type"), text.alias("text"), first["start"].alias("start"), end.alias("end"), first["confidence"].alias("confidence"))

    # every text is trimmed once
    return let(trim_bleed(etype, first["text"]), lambda x: let(clean_value(etype, x), made))


_LOOKAHEAD = r"(?![\p{L}\p{N}_])"
_EDGES = " ,.;:-"
_CLASS_VALUE = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\u" + m[1].zfill(4), CLASS_VALUE.replace(_LOOKAHEAD, r"(?!\w)")))
FIRSTS = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in {"ord": T.LongType(), "type": T.StringType(), "text": T.StringType(), "later": T.StringType(), "start": T.LongType(), "end": T.LongType(), "confidence": T.DoubleType()}.items()]))


def _where(texts: pa.Array, pattern: str, change, tested: pa.Array | None = None) -> pa.Array:
    """``change`` of the texts that match (or whose ``tested`` does); most do not."""
    hit = pc.match_substring_regex(texts if tested is None else tested, pattern)
    return pc.replace_with_mask(texts, hit, change(texts.filter(hit))) if pc.any(hit).as_py() else texts


def trim_bleed_texts(etype: str, texts: pa.Array) -> pa.Array:
    """``trim_bleed`` of many texts of one type at once."""
    gone = lambda pattern, by="": lambda t: pc.replace_substring_regex(t, pattern=pattern, replacement=by)
    strip = lambda t: _where(_where(t, rf"^{WS}", gone(rf"^{WS}+")), rf"{WS}\z", gone(rf"{WS}+\z"))
    each = lambda f: lambda t: pa.array([f(x) for x in t.to_pylist()], pa.string())
    texts = strip(texts)
    for label in LEADING_LABELS:
        pattern = label.replace("(?iu)", "(?i)")
        texts = _where(texts, pattern, gone(pattern))
    address = "ADDRESS" in etype
    if address:
        # the library's expressions have no lookahead: they find candidates
        texts = _where(texts, CLASS_VALUE.replace("(?iu)", "(?i)").replace(_LOOKAHEAD, ""), each(lambda x: _CLASS_VALUE.sub(" ", x)))
        texts = pc.utf8_trim(_where(texts, rf"{WS}{{2}}", gone(rf"{WS}{{2,}}", " ")), characters=_EDGES)
    if any(t in etype for t in FREE_TEXT):
        markers = CUT_MARKERS if address else CLASS_MARKERS + CUT_MARKERS

        def cut(x: str) -> str:
            low = x.lower()
            places = [p for p in map(low.find, markers) if p > 0]
            return x[: min(places)].strip(_EDGES) if places else x

        texts = _where(texts, "|".join(map(re.escape, markers)).replace("\\ ", " "), each(cut), pc.utf8_lower(texts))
    return strip(texts)


def first_lists(entities: pa.Array) -> pa.Array:
    """``deduplicate`` of every document's list of entities, but for ``clean_value``: the first of each type with its text trimmed,
    and in ``later`` the further texts of address, notes and diagnosis (null without any)."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(entities), 0), np.int64)
    flat = entities.flatten()
    coded = flat.field("type").dictionary_encode()
    names, kind = coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64)
    merged = np.array([any(m in t for m in MERGED) for t in names], bool)[kind] if names else np.zeros(0, bool)
    group, first, of = np.unique(np.repeat(np.arange(len(sizes)), sizes) * max(len(names), 1) + kind, return_index=True, return_inverse=True)
    heads = np.zeros(len(flat), bool)
    heads[first] = True
    own = [np.flatnonzero((heads | merged) & (kind == k)) for k in range(len(names))]
    place = np.zeros(len(flat), np.int64)
    place[np.concatenate(own) if own else []] = np.arange(sum(map(len, own)))
    text = pa.concat_arrays([pa.array([], pa.string()), *(trim_bleed_texts(t, flat.field("text").take(pa.array(i))) for t, i in zip(names, own))])
    # later members of a group, in order; a group is seen in the order of its first member
    rank = np.empty(len(group), np.int64)
    rank[np.argsort(first)] = np.arange(len(group))
    first, of = np.sort(first), rank[of]
    last = first.copy()
    np.maximum.at(last, of[merged], np.flatnonzero(merged))
    more = np.flatnonzero(merged & ~heads)
    more = more[np.argsort(of[more], kind="stable")]
    n = np.bincount(of[more], minlength=len(first))
    upto = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
    later = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto), text.take(pa.array(place[more]))), ", ")
    at = lambda c, i: flat.field(c).take(pa.array(i))
    fields = [at("ord", first), at("type", first), text.take(pa.array(place[first])), pc.if_else(pa.array(n > 0), later, None), at("start", first), at("end", last), at("confidence", first)]
    docs = np.searchsorted(first, np.concatenate(([0], np.cumsum(sizes)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(docs, mask=np.append(np.asarray(entities.is_null()), False)), pa.StructArray.from_arrays(fields, names=FIRSTS.elementType.names))


def finished(x: Column) -> Column:
    """An entity of ``first_lists`` with its whole text."""
    head = clean_value(x["type"], x["text"])
    text = F.when(x["later"].isNull(), head).otherwise(F.concat(head, F.lit(", "), x["later"]))
    return F.struct(x["ord"].alias("ord"), x["type"].alias("type"), text.alias("text"), x["start"].alias("start"), x["end"].alias("end"), x["confidence"].alias("confidence"))


def merge_fold(entities: DataFrame, *key: str, mergeable: tuple[str, ...] = FREE_TEXT) -> DataFrame:
    """The earlier policy: later texts of mergeable types are appended with a space unless already inside,
    the end is the largest, the confidence the pairwise mean in order; other types keep their first entity."""
    parts = F.array_sort(F.collect_list(F.struct("ord", "text", "start", "end", "confidence")))
    rows = entities.groupBy(*key, "type").agg(parts.alias("p"))

    def step(acc: Column, x: Column) -> Column:
        text = F.when(F.contains(acc["text"], x["text"]), acc["text"]).otherwise(F.concat(acc["text"], F.lit(" "), x["text"]))
        return F.struct(acc["ord"].alias("ord"), text.alias("text"), acc["start"].alias("start"), F.greatest(acc["end"], x["end"]).alias("end"), F.round((acc["confidence"] + x["confidence"]) / 2, 4).alias("confidence"))

    first = F.col("p")[0]
    folded = F.aggregate(F.slice("p", 2, F.size("p")), first, step)
    x = F.when(F.col("type").isin(*mergeable), folded).otherwise(first)
    return rows.withColumn("x", x).select(*key, "x.ord", "type", "x.text", "x.start", "x.end", "x.confidence")


def first_valid(entities: DataFrame, *key: str) -> DataFrame:
    """The earliest policy: invalid entities go before the first of each type is taken."""
    order = Window.partitionBy(*key, "type").orderBy("ord")
    return entities.where(is_valid(F.col("type"), F.col("text"), "legacy")).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def is_valid(etype: Column, text: Column, policy: str = "sdk") -> Column:
    """Whether a value fits its type; types without a rule pass. Policies: sdk, repo (anchored dates,
    strict ids), legacy (repo and a rule for nationality)."""
    bare = strip_ws(text)
    tight = F.regexp_replace(text, WS, "")
    words = word_count(text)
    date = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
    some_date = bare.rlike(date) if policy == "sdk" else bare.rlike(rf"^{date}\z")
    gender = normalize_gender(bare).isin("Nam", "Nữ")
    rules = {
        "PATIENT_DOB": bare.rlike(rf"^({date}|[0-9]{{4}})\z"),
        "DOB": some_date,
        "ADMISSION_DATE": bare.rlike(r"[0-9]{1,2}[^\n]*[0-9]{4}"),
        "DISCHARGE_DATE": bare.rlike(r"[0-9]{1,2}[^\n]*[0-9]{4}"),
        "DATE_OF_EXPIRY": some_date,
        "PATIENT_GENDER": gender,
        "GENDER": gender,
        "PATIENT_ETHNICITY": words.between(1, 3),
        "PATIENT_NAME": words.between(2, 7) & ~text.rlike(r"\p{Nd}"),
        "FULL_NAME": bare.rlike(rf"(?iu)^([{NAME_LETTERS}]|{WS})+\z") & words.between(2, 6),
        "ID_NUMBER": tight.rlike(r"^[0-9]{9,13}\z") if policy == "sdk" else bare.rlike(r"^([0-9]{9}|[0-9]{12})\z"),
        "BHXH_CODE": F.length(tight) >= 8,
        "MEDICAL_CODE": text.rlike(r"\p{Nd}"),
        "DIAGNOSIS": F.length(bare) >= 5,
        "TREATMENT_METHOD": F.length(bare) >= 5,
    }
    if policy == "legacy":
        rules["NATIONALITY"] = words.between(1, 4)
    out = None
    for name, rule in rules.items():
        out = (F.when if out is None else out.when)(etype == name, rule)
    return out.otherwise(F.lit(True))
