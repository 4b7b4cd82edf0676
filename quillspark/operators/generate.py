"""Synthetic records for testing text, reproducible whatever the partitioning.

Every draw is a hash of (seed, row, slot), so record n is the same on one core
or a thousand. The records are text to test readers with, not to forge papers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions.text import digits, integer, pick, uniform


def join_parts(*parts: Column | str) -> Column:
    return reduce(F.concat, [F.lit(p) if isinstance(p, str) else p for p in parts])


class Draws:
    """Draws of one record: named slots under a seed and the record's number."""

    def __init__(self, seed: int, doc_type: str, row: Column) -> None:
        self.seed, self.row = f"{seed}|{doc_type}", row

    def u(self, slot: str) -> Column:
        return uniform(self.seed, self.row, slot)

    def pick(self, values, slot: str) -> Column:
        return pick(list(values), self.u(slot))

    def int(self, low: int, high: int, slot: str) -> Column:
        return integer(self.u(slot), low, high)

    def text(self, low: int, high: int, slot: str) -> Column:
        return self.int(low, high, slot).cast("string")

    def digits(self, n: int, slot: str) -> Column:
        return digits(self.seed, self.row, slot, n)

    def day(self, first: str, span: int, slot: str) -> Column:
        return F.date_add(F.to_date(F.lit(first)), self.int(0, span, slot))

    def pair(self, values, slot: str) -> tuple[Column, Column]:
        """Both halves of one drawn pair."""
        return self.pick([a for a, _ in values], slot), self.pick([b for _, b in values], slot)

    def name(self, names, slot: str) -> Column:
        return join_parts(self.pick(D.SURNAMES, f"{slot}.s"), " ", self.pick(names, f"{slot}.n"))

    def address(self, slot: str) -> Column:
        """One of four styles: hamlet, street number, ward only, alley."""
        at = lambda x: f"{slot}.{x}"
        ward, district, province = self.pick(D.WARDS, at("w")), self.pick(D.DISTRICTS, at("d")), self.pick(D.PROVINCES, at("p"))
        tail = join_parts(ward, ", ", district, ", ", province)
        street = self.pick(D.STREETS, at("st"))
        style = self.int(0, 3, at("style"))
        hamlet = join_parts("Thôn ", self.pick(D.HAMLETS, at("h")), ", ", tail)
        number = join_parts(self.text(1, 300, at("no")), " ", street, ", ", tail)
        alley = join_parts(self.text(1, 999, at("a")), "/", self.text(1, 99, at("b")), "/", self.text(1, 30, at("c")), " ", street, ", KP", self.text(1, 5, at("kp")), ", ", tail)
        return F.when(style == 0, hamlet).when(style == 1, number).when(style == 2, tail).otherwise(alley)

    def city(self, slot: str) -> Column:
        return join_parts(self.pick(D.DISTRICTS, f"{slot}.d"), ", ", self.pick(D.PROVINCES, f"{slot}.p"))


def vn_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def days_between(first: str, last: str) -> int:
    from datetime import date

    return (date.fromisoformat(last) - date.fromisoformat(first)).days


def identity_card(d: Draws) -> dict[str, Column]:
    issue = d.day("2016-01-01", 3000, "issue")
    return {
        "id_number": d.digits(12, "id"), "full_name": F.upper(d.name(D.PERSON_NAMES, "name")), "date_of_birth": vn_date(d.day("1960-01-01", days_between("1960-01-01", "2005-12-31"), "dob")),
        "gender": d.pick(D.GENDERS, "gender"), "nationality": F.lit(D.NATIONALITY), "place_of_origin": d.city("origin"), "place_of_residence": d.address("home"), "date_of_expiry": vn_date(F.date_add(issue, 3650)),
    }


def driving_licence(d: Draws) -> dict[str, Column]:
    issue = d.day("2015-01-01", 3000, "issue")
    return {
        "id_number": d.digits(12, "id"), "full_name": F.upper(d.name(D.DRIVER_NAMES, "name")), "date_of_birth": vn_date(d.day("1970-01-01", days_between("1970-01-01", "2005-12-31"), "dob")),
        "nationality": F.lit(D.NATIONALITY), "address": d.address("home"), "issue_date": vn_date(issue), "expiry_date": vn_date(F.date_add(issue, 3650)), "class": d.pick(D.LICENCE_CLASSES, "class"),
    }


def birth_certificate(d: Draws) -> dict[str, Column]:
    born = d.day("2010-01-01", 5000, "dob")
    return {
        "id_number": d.digits(12, "id"), "full_name": F.upper(d.name(D.CHILD_NAMES, "name")), "gender": d.pick(D.GENDERS, "gender"), "date_of_birth": vn_date(born), "dob_text": F.lit("Một ngày nào đó"),
        "place_of_birth": d.city("birth"), "ethnicity": F.lit("Kinh"), "nationality": F.lit(D.NATIONALITY), "father_name": F.upper(d.name(D.CHILD_NAMES, "father")), "mother_name": F.upper(d.name(D.CHILD_NAMES, "mother")),
        "registration_place": d.city("office"), "registration_date": vn_date(F.date_add(born, d.int(1, 30, "wait"))),
    }


def vehicle_registration(d: Draws) -> dict[str, Column]:
    day = d.day("2015-01-01", days_between("2015-01-01", "2025-12-31"), "day")
    province, letter = d.pick(D.PLATE_PROVINCES, "plate.p"), d.pick(D.PLATE_LETTERS, "plate.l")
    motorbike = join_parts(province, letter, d.text(0, 9, "plate.d"), " ", d.text(10000, 99999, "plate.n"))
    car = join_parts(province, letter, "-", d.text(100, 999, "plate.a"), ".", d.text(10, 99, "plate.b"))
    return {
        "owner_name": F.upper(d.name(D.DRIVER_NAMES, "name")), "owner_address": d.address("home"), "plate_number": F.when(d.u("plate") < 0.5, motorbike).otherwise(car), "id_number": d.digits(8, "id"),
        "vehicle_type": d.pick(D.VEHICLE_TYPES, "type"), "brand": d.pick(D.BRANDS, "brand"), "model_code": d.pick(D.MODELS, "model"), "engine_number": join_parts(d.pick(D.ENGINE_PREFIXES, "engine"), d.digits(7, "engine")),
        "chassis_number": join_parts(d.pick(D.CHASSIS_PREFIXES, "chassis"), d.digits(10, "chassis")), "color": d.pick(D.COLORS, "color"), "manufacture_year": d.text(2010, 2024, "year"),
        "manufacture_country": d.pick(D.COUNTRIES, "country"), "registration_date": vn_date(day), "expiry_date": vn_date(F.date_add(day, 730)),
    }


def discharge_paper(d: Draws) -> dict[str, Column]:
    hospital, authority = d.pair(D.HOSPITALS, "hospital")
    one, two = (join_parts(d.pair(D.DIAGNOSES, s)[1], " (", d.pair(D.DIAGNOSES, s)[0], ")") for s in ("diagnosis", "diagnosis2"))
    name, case = d.name(D.PATIENT_NAMES, "name"), d.u("case")
    born = d.day("1940-01-01", days_between("1940-01-01", "2020-12-31"), "dob")
    admit = d.day("2020-01-01", 1500, "admit")
    style = d.int(0, 3, "format")

    def when(day: Column, slot: str) -> Column:
        hour, minute = d.text(6, 22, f"{slot}.h"), F.lpad(d.text(0, 59, f"{slot}.m"), 2, "0")
        long = join_parts("ngày ", F.day(day).cast("string"), " tháng ", F.month(day).cast("string"), " năm ", F.year(day).cast("string"))
        short = join_parts(F.day(day).cast("string"), "/", F.month(day).cast("string"), "/", F.year(day).cast("string"))
        return F.when(style == 0, join_parts(hour, " giờ ", minute, " phút, ", long)).when(style == 1, join_parts(hour, " giờ ", minute, " ", long)).when(style == 2, short).otherwise(long)

    code = d.int(0, 2, "bhxh")
    groups = [F.substring(d.digits(5, f"bhxh{i}"), 1, d.int(3, 5, f"bhxh.len{i}")) for i in range(3)]
    insurance = F.when(code == 0, join_parts("GD", d.digits(13, "bhxh"))).when(code == 1, join_parts("HS ", groups[0], " ", groups[1], " ", groups[2])).otherwise(join_parts("GD ", d.text(1, 9, "bhxh.a"), " ", d.text(10, 99, "bhxh.b"), " ", d.digits(11, "bhxh.c")))
    return {
        "hospital_name": hospital, "dept_mgmt": authority, "department": d.pick(D.DEPARTMENTS, "department"), "medical_code": join_parts(d.text(20, 24, "med.y"), ".", F.lpad(d.text(1000, 99999, "med.n"), 6, "0")),
        "patient_name": F.when(case < 0.4, F.upper(name)).when(case < 0.7, name).otherwise(F.lower(name)), "patient_dob": F.when(d.u("year only") < 0.3, F.date_format(born, "yyyy")).otherwise(vn_date(born)),
        "patient_gender": d.pick(D.GENDERS, "gender"), "patient_ethnicity": d.pick(D.ETHNICITIES, "ethnicity"), "patient_occupation": d.pick(D.OCCUPATIONS, "occupation"), "patient_address": d.address("home"),
        "bhxh_code": insurance, "admission_date": when(admit, "in"), "discharge_date": when(F.date_add(admit, d.int(1, 20, "stay")), "out"),
        "diagnosis": F.when(d.u("two") < 0.4, join_parts(one, "; ", two)).otherwise(one), "treatment_method": d.pick(D.TREATMENTS, "treatment"), "notes": d.pick(D.NOTES, "notes"),
    }


GENERATORS = {"cccd": identity_card, "gplx": driving_licence, "giay_khai_sinh": birth_certificate, "vehicle_registration": vehicle_registration, "giay_ra_vien": discharge_paper}


def records_for(keys: DataFrame, doc_type: str, seed: int = 42) -> DataFrame:
    """row_id and the fields of a document type, one record for every ``row_id`` of ``keys``."""
    if doc_type not in GENERATORS:
        raise ValueError(f"no generator for {doc_type!r}; known: {', '.join(sorted(GENERATORS))}")
    return keys.select("row_id", *(c.alias(name) for name, c in GENERATORS[doc_type](Draws(seed, doc_type, F.col("row_id"))).items()))


def generate_records(spark: SparkSession, doc_type: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` records, numbered from 0."""
    return records_for(spark.range(n).withColumnRenamed("id", "row_id"), doc_type, seed)
