"""From entities to one wide row per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import deduplicate, first_of_type, is_valid

# Type to field, per document type.
DEFAULT_MAPPINGS = {
    "cccd": {
        "ID_NUMBER": "id_number", "FULL_NAME": "name", "DOB": "date_of_birth", "GENDER": "gender", "NATIONALITY": "nationality",
        "PLACE_OF_ORIGIN": "place_of_origin", "PLACE_OF_RESIDENCE": "address", "DATE_OF_EXPIRY": "expiry_date",
    },
    "giay_ra_vien": {
        "HOSPITAL_NAME": "hospital_name", "DEPARTMENT": "department", "MEDICAL_CODE": "medical_code", "PATIENT_NAME": "patient_name", "PATIENT_DOB": "patient_dob",
        "PATIENT_GENDER": "patient_gender", "PATIENT_ETHNICITY": "patient_ethnicity", "PATIENT_OCCUPATION": "patient_occupation", "PATIENT_ADDRESS": "patient_address",
        "BHXH_CODE": "bhxh_code", "ADMISSION_DATE": "admission_date", "DISCHARGE_DATE": "discharge_date", "DIAGNOSIS": "diagnosis", "TREATMENT_METHOD": "treatment_method", "NOTES": "notes",
    },
}

#: The other set of defaults, whose fields are named like their types.
REPO_TYPES = {
    "cccd": ("ID_NUMBER", "FULL_NAME", "DOB", "GENDER", "NATIONALITY", "PLACE_OF_ORIGIN", "PLACE_OF_RESIDENCE", "DATE_OF_EXPIRY"),
    "giay_ra_vien": ("HOSPITAL_NAME", "DEPT_MGMT", "DEPARTMENT", "MEDICAL_CODE", "PATIENT_NAME", "PATIENT_DOB", "PATIENT_GENDER", "PATIENT_ETHNICITY", "PATIENT_OCCUPATION", "PATIENT_ADDRESS", "BHXH_CODE", "ADMISSION_DATE", "DISCHARGE_DATE", "DIAGNOSIS", "TREATMENT_METHOD", "NOTES"),
    "vehicle_registration": ("OWNER_NAME", "OWNER_ADDRESS", "PLATE_NUMBER", "VEHICLE_TYPE", "BRAND", "MODEL_CODE", "ENGINE_NUMBER", "CHASSIS_NUMBER", "MANUFACTURE_YEAR", "MANUFACTURE_COUNTRY", "EXPIRY_DATE", "REGISTRATION_DATE"),
    "gplx": ("ID_NUMBER", "FULL_NAME", "DOB", "NATIONALITY", "ADDRESS", "ISSUE_DATE", "EXPIRY_DATE", "CLASS"),
    "giay_khai_sinh": ("ID_NUMBER", "FULL_NAME", "GENDER", "DOB", "DOB_TEXT", "PLACE_OF_BIRTH", "ETHNICITY", "NATIONALITY", "FATHER_NAME", "MOTHER_NAME", "REGISTRATION_PLACE", "REGISTRATION_DATE"),
}
REPO_MAPPINGS = {t: {e: "date_of_birth" if e == "DOB" else e.lower() for e in types} for t, types in REPO_TYPES.items()}


def json_fields(entities: DataFrame, *key: str) -> DataFrame:
    """key, record: a JSON object of lower-case type to text, in order of type."""
    listed = F.array_sort(F.collect_list(F.struct(F.lower("type").alias("key"), F.col("text").alias("value"))))
    return entities.groupBy(*key).agg(F.to_json(F.map_from_entries(listed)).alias("record"))


def map_entity_arrays(rows: DataFrame, mapping: dict[str, str], *key: str, entities: str = "entities", fields: list[str] | None = None, clean: bool = True, validate: bool = True, with_confidence: bool = False) -> DataFrame:
    """``map_entities`` for documents that carry their entities as an array in order: one projection, no shuffle."""
    fields = fields or list(dict.fromkeys(mapping.values()))
    made = rows.select(*key, F.col(entities).alias("__e"))
    for n, etype in enumerate(mapping):
        own = F.filter("__e", lambda x: x["type"] == etype)
        made = made.withColumn(f"__{n}", first_of_type(etype, own) if clean else F.try_element_at(own, F.lit(-1)))
        if validate:
            made = made.withColumn(f"__{n}", F.when(is_valid(F.lit(etype), F.col(f"__{n}.text")), F.col(f"__{n}")))
    out = list(key)
    for f in fields:
        found = [F.struct(F.col(f"__{n}.ord").alias("ord"), F.col(f"__{n}.text").alias("text"), F.col(f"__{n}.confidence").alias("confidence")) for n, t in enumerate(mapping) if mapping[t] == f]
        last = F.array_max(F.filter(F.array(*found), lambda x: x["ord"].isNotNull())) if found else F.lit(None).cast("struct<ord:long,text:string,confidence:double>")
        text = F.coalesce(last["text"], F.lit(""))
        out.append((F.struct(text.alias("value"), F.coalesce(last["confidence"], F.lit(0.0)).alias("confidence")) if with_confidence else text).alias(f))
    return made.select(*out)


def mapping_of_labels(labels: list[str]) -> dict[str, str]:
    """Upper-case type to field for B- and I- labels, the first field of each type."""
    out: dict[str, str] = {}
    for label in labels:
        prefix, dash, field = label.partition("-")
        if dash and prefix in ("B", "I") and field:
            out.setdefault(field.replace("_VALUE", "").upper(), field)
    return out


def choose_mapping(doc_type: str, explicit: dict[str, str] | None = None, labels: list[str] | None = None) -> dict[str, str]:
    """An explicit mapping, else one of the labels, else the default, else none."""
    return explicit or mapping_of_labels(labels or []) or DEFAULT_MAPPINGS.get(doc_type, {})


def map_entities(entities: DataFrame, documents: DataFrame, mapping: dict[str, str], *key: str, fields: list[str] | None = None, clean: bool = True, validate: bool = True, with_confidence: bool = False) -> DataFrame:
    """key and one column per field for every document: the last entity of the field, "" where there is none.

    With confidence a field is a struct (value, confidence), 0.0 where there is none.
    """
    if clean:
        entities = deduplicate(entities, *key)
    if validate:
        entities = entities.where(is_valid(F.col("type"), F.col("text")))
    fields = fields or list(dict.fromkeys(mapping.values()))
    of_field = {f: [t for t, x in mapping.items() if x == f] for f in fields}
    value = lambda f, c: F.max_by(F.when(F.col("type").isin(*of_field[f]), F.col(c)), F.when(F.col("type").isin(*of_field[f]), F.col("ord")))
    picked = entities.groupBy(*key).agg(*(value(f, "text").alias(f"v_{f}") for f in fields), *(value(f, "confidence").alias(f"c_{f}") for f in fields))
    rows = documents.select(*key).join(picked, list(key), "left")
    text = lambda f: F.coalesce(f"v_{f}", F.lit(""))
    if with_confidence:
        return rows.select(*key, *(F.struct(text(f).alias("value"), F.coalesce(f"c_{f}", F.lit(0.0)).alias("confidence")).alias(f) for f in fields))
    return rows.select(*key, *(text(f).alias(f) for f in fields))
