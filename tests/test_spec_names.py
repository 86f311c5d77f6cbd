"""Profile spec: the specification's sample rows, a dictionary from a table, confidences and the SQL."""
import pytest

from rostrum.functions import spec_names as S
from rostrum.operators.names import NAME_PARTS, clean_names, parse_issues, token_dictionary

#: value -> first, middle, last, designation, organization
SAMPLES = {
    "Doe, John": ("John", None, "Doe", None, None),
    "Doe, John A.": ("John", "A", "Doe", None, None),
    "John A Doe": ("John", "A", "Doe", None, None),
    "Doe, John, MD": ("John", None, "Doe", "MD", None),
    "Doe, John MD": ("John", None, "Doe", "MD", None),
    "St Mary Hospital": (None, None, None, None, "St Mary Hospital"),
    "CARE Clinic / Community Health": (None, None, None, None, "CARE Clinic / Community Health"),
    "Smith, Anna, MD, City Hospital": ("Anna", None, "Smith", "MD", "City Hospital"),
    "Prince": ("Prince", None, None, None, None),
    "Brown John MI": ("John", "MI", "Brown", None, None),
    "Wilson, Mary, PhD": ("Mary", None, "Wilson", "PhD", None),
    "Apollo Pharmacy Pvt Ltd": (None, None, None, None, "Apollo Pharmacy Pvt Ltd"),
    # further forms that the specification names
    "Doe, John Albert": ("John", "Albert", "Doe", None, None),
    "John Doe": ("John", None, "Doe", None, None),
    "John Doe, PhD": ("John", None, "Doe", "PhD", None),
    "Mercy (other)": (None, None, None, None, "Mercy (other)"),
    "Dr. John Doe Jr.": ("John", None, "Doe", "Dr, Jr", None),
    "Doe,  John ,, m.d. , III;": ("John", None, "Doe", "MD, III", None),
    "Yo Ma": ("Yo", None, "Ma", None, None),
    "MD": (None, None, None, "MD", None),
    "Doe, Ann, Zed, RN": ("Ann", None, "Doe", "RN", None),
    "": (None,) * 5, " , ; ": (None,) * 5,
}
PARTS = ["first_name", "middle_name", "last_name", "designation", "organization_name"]


@pytest.fixture(scope="module")
def values(spark):
    rows = [*enumerate(SAMPLES), (len(SAMPLES), None)] + [(100 + k, "Doe, John, MD") for k in range(3)]
    return spark.createDataFrame(rows, "id long, header_col_value string")


def built_in_rows():
    return ([(w, "designation", w) for w in S.DESIGNATIONS] + [(w, "organization", None) for w in S.ORGANIZATION_KEYWORDS]
            + [(w, "title", None) for w in S.TITLES])


def test_samples(values):
    got = {r.header_col_value: tuple(r[c] for c in PARTS) for r in clean_names(values, "spec").collect()}
    assert got == {**SAMPLES, None: (None,) * 5}


def test_rules_and_issues(values):
    parsed = clean_names(values, "spec")
    rules = {r.header_col_value: (r.parse_rule, r.parse_confidence, r.unassigned) for r in parsed.collect()}
    assert rules["Doe, John"] == ("last, first", 0.95, None) and rules["Prince"] == ("single name", 0.5, None)
    assert rules["Doe, Ann, Zed, RN"] == ("last, first", 0.65, "Zed") and rules[None] == ("empty", 0.0, None)
    assert rules["Brown John MI"][0] == "last first initials" and rules["MD"][0] == "credential only"
    issues = {r.header_col_value: r.reason for r in parse_issues(parsed, threshold=0.55).collect()}
    assert issues == {"Prince": "low confidence: single name", "MD": "low confidence: credential only", None: "low confidence: empty",
                      "": "low confidence: empty", " , ; ": "low confidence: empty"}


def test_table_gives_what_the_lists_give(spark, values):
    table = spark.createDataFrame(built_in_rows(), "token string, kind string, canonical string")
    one, other = (sorted(map(tuple, frame.collect()), key=str)
                  for frame in (clean_names(values, "spec"), clean_names(values, "spec", designations=table)))
    assert one == other


def test_own_table(spark):
    names = spark.createDataFrame([("Doe, Ann, OTR/L",), ("Doe, Ann, XYZ, Blue House",), ("Doe, Ann, MD",)], "header_col_value string")
    table = spark.createDataFrame([("x.y.z", "Designation", "XyZ"), ("house", " organization", None), (None, "title", None), ("x", None, None)],
                                  "token string, kind string, canonical string")
    got = {r[0]: (r.designation, r.organization_name, r.unassigned) for r in clean_names(names, "spec", designations=table).collect()}
    assert got == {"Doe, Ann, OTR/L": (None, "OTR/L", None), "Doe, Ann, XYZ, Blue House": ("XyZ", "Blue House", None),
                   "Doe, Ann, MD": (None, None, "MD")}
    empty = clean_names(names, "spec", designations=table.limit(0))
    assert {r.unassigned for r in empty.collect()} == {None, "XYZ, Blue House", "MD"}
    with pytest.raises(ValueError):
        clean_names(names, "credential_clean", designations=table)


def test_table_is_joined_not_collected(spark, values):
    table = spark.createDataFrame(built_in_rows(), "token string, kind string, canonical string")
    plan = clean_names(values, "spec", designations=table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "broadcast" not in plan.lower()


def test_one_key_with_several_rows(spark):
    table = spark.createDataFrame([("Dr", "title", None), ("dr.", "designation", "Dr"), ("DR", "designation", "A"), ("", "title", None)],
                                  "token string, kind string, canonical string")
    assert [tuple(r) for r in token_dictionary(table).collect()] == [("dr", "A", False, True)]


@pytest.mark.parametrize("profile", list(NAME_PARTS))
def test_confidence_of_other_profiles(spark, profile):
    rows = [(1, "Doe, John"), (2, "St Mary Hospital"), (3, None), (4, "")]
    names = spark.createDataFrame(rows, "id int, header_col_value string")
    keep = ["id"] if profile.startswith("degree") else None
    plain = clean_names(names, profile, keep=keep)
    sure = clean_names(names, profile, keep=keep, confidence=True)
    assert sure.columns == [*plain.columns, "parse_rule", "parse_confidence"]
    assert sorted(map(str, sure.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    got = {r.id: (r.parse_rule, r.parse_confidence) for r in sure.collect()}
    assert got[1] == ("last, first", 0.95) and got[3] == got[4] == ("empty", 0.0)
    assert parse_issues(sure, threshold=0.1).count() >= 2


def test_extra_columns_keep_their_values(spark):
    names = spark.createDataFrame([("Doe, John", "kept", 7)], "header_col_value string, text string, place int")
    assert clean_names(names, "spec").select("text", "place", "first_name").first() == ("kept", 7, "John")
    table = spark.createDataFrame(built_in_rows(), "token string, kind string, canonical string")
    assert clean_names(names, "spec", designations=table).select("text", "place", "first_name").first() == ("kept", 7, "John")
