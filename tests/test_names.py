"""Name profiles against the hand-traced golden table."""
import pytest

from rostrum.operators.names import clean_names, exclude_files

# input -> {profile: "first|middle|last|designation|organization"}
GOLDEN = {
    "Doe, John": {"N1": "John||Doe|NA|", "N3": "John||Doe||", "N6": "John||Doe||"},
    "Doe, John A.": {"N1": "John|A.|Doe|NA|", "N3": "John|A|Doe||", "N4": "John|A.|Doe||",
                     "N5": "John|A|Doe||", "N6": "John|A.|Doe||"},
    "Doe, John, MD": {"N1": "John||Doe|MD|", "N4": "John||Doe|MD|", "N6": "John,||Doe|MD|"},
    "DOE, JOHN": {"N1": "|||JOHN|", "N2": "John||Doe|NA|", "N3": "|||JOHN,DOE|DOE, JOHN",
                  "N4": "|||DOE,JOHN,DOE|", "N5": "|||DOE,JOHN,DOE|", "N6": "||||DOE, JOHN"},
    "Jones, Amy, MD, RN": {"N1": "Amy||Jones|MD, RN|", "N3": "Amy||Jones|MD,RN|", "N4": "Amy,MD||Jones|MD,RN|",
                           "N6": "Amy,|,|Jones|MD, RN|"},
    "Wilson, Mary, PhD": {"N1": "Mary||Wilson|PhD|", "N3": "Mary,||Wilson||", "N5": "Mary||Wilson||",
                          "N6": "Mary,||Wilson|PHD|"},
    "Brown John MI": {"N1": "Brown||John|MI|", "N2": "Brown|John|Mi|NA|", "N3": "Brown||John|MI|",
                      "N6": "Brown|John|MI||"},
    "Maria de la Cruz": {"N1": "Maria|De La|Cruz|NA|", "N3": "Maria||de la Cruz||", "N6": "Maria|de la|Cruz||"},
    "Prince": {"N1": "Prince|||NA|", "N3": "||||Prince", "N4": "Prince||||", "N6": "Prince||||"},
    "St Mary Hospital": {"N1": "||||St Mary Hospital", "N3": "||||St Mary Hospital", "N4": "St|Mary|Hospital||"},
    "Smith, Anna, MD, City Hospital": {"N1": "||||Smith, Anna, MD, City Hospital",
                                       "N4": "Anna,|MD, City Hospital|Smith||",
                                       "N5": "Anna|City Hospital|Smith||",
                                       "N6": "|||MD|Smith, Anna, , City Hospital"},
    "Doe, John, Jr, MD": {"N1": "John||Doe Jr|MD|"},
    "Dr. Mr. Lee Wong": {"N1": "Lee||Wong|NA|"},
    "MD": {"N1": "|||NA|", "N6": "|||MD|"},
    "John Q Public Jr": {"N6": "John|Q|Public Jr||"},
    "John Smith (ABC DEF)": {"N6": "John||Smith||ABC DEF"},
    "Van Der Berg": {"N3": "Van||Van Der Berg||", "N4": "Van||Van Der Berg||", "N5": "Van||Van Der Berg||"},
}
PROFILE = {"N1": "degree_caps", "N2": "degree_dict", "N3": "credential_org", "N4": "credential_list",
           "N5": "credential_clean", "N6": "format_detect"}


def _fmt(profile, r):
    if profile.startswith("degree"):
        vals = [r.firstname, r.middlename, r.lastname, r.medical_degree, r.organization]
    elif profile == "format_detect":
        vals = [r.first_name_parsed, r.middle_name_parsed, r.last_name_parsed, r.designation_parsed,
                r.organization_parsed]
    else:
        vals = [r.first_name, r.middle_name, r.last_name, r.designation, r.organization]
    return "|".join("" if v is None else v for v in vals)


@pytest.fixture(scope="module")
def parsed(spark):
    texts = list(GOLDEN)
    df = spark.createDataFrame([(i, t, "a.xlsx") for i, t in enumerate(texts)],
                               "id int, header_col_value string, file_name string")
    out = {}
    for key, prof in PROFILE.items():
        rows = clean_names(df, prof, keep=["id"] if prof.startswith("degree") else None).collect()
        out[key] = {texts[r["id"]]: _fmt(prof, r) for r in rows}
    return out


@pytest.mark.parametrize("key", list(PROFILE))
def test_golden(parsed, key):
    for text, exp in GOLDEN.items():
        if key in exp:
            assert parsed[key][text] == exp[key], (key, text)


def test_null_and_blank(spark):
    df = spark.createDataFrame([(1, None, None), (2, "  ", "x")], "id int, header_col_value string, file_name string")
    for prof in PROFILE.values():
        rows = clean_names(df, prof, keep=["id"] if prof.startswith("degree") else None).collect()
        assert len(rows) == 2


def test_roster_file_tag_and_exclusion(spark):
    roster = "Roster Files - top 20 entities_desensitized.xlsx"
    df = spark.createDataFrame([(1, "Doe, John", roster), (2, "Roe, Ann", "old.xlsx"), (3, "Poe, Al", " OLD.XLSX ")],
                               "id int, header_col_value string, file_name string")
    out = clean_names(df, "credential_clean", exclude=["old.xlsx", roster]).collect()
    assert {r["id"]: r["organization"] for r in out} == {1: roster}
    kept = exclude_files(df, "file_name", spark.createDataFrame([("old.xlsx",)], "file_name string"))
    assert sorted(r["id"] for r in kept.collect()) == [1]


def test_unicode_spaces_and_letters(spark):
    # Python's str.strip()/\s treat the non-breaking space as whitespace; so do the Spark rules
    df = spark.createDataFrame([(1, "Doe, John "), (2, "élodie dupont"), (3, " Émile Zola, MD")],
                               "id int, header_col_value string")
    n1 = {r["id"]: (r["firstname"], r["lastname"], r["medical_degree"])
          for r in clean_names(df, "degree_dict", keep=["id"]).collect()}
    assert n1 == {1: ("John", "Doe", "NA"), 2: ("Élodie", "Dupont", "NA"), 3: ("Émile", "Zola", "MD")}
    n6 = {r["id"]: (r["detected_format"], r["first_name_parsed"], r["last_name_parsed"])
          for r in clean_names(df, "format_detect").collect()}
    assert n6[1] == ("last_name,first_name", "John", "Doe")
    assert n6[2] == ("first_name last_name", "élodie", "dupont")


def test_observed_exclusion_counts(spark):
    from rostrum.operators.names import observe_exclusion
    df = spark.createDataFrame([(1, "a", "old.xlsx"), (2, "b", "new.xlsx"), (3, "c", " OLD.xlsx")],
                               "id int, header_col_value string, file_name string")
    observed, obs = observe_exclusion(df, "file_name", ["old.xlsx"])
    clean_names(observed, "credential_clean", exclude=["old.xlsx"]).write.format("noop").mode("overwrite").save()
    assert obs.get == {"n_input": 3, "n_excluded": 2}


def test_user_filters_on_outputs_stay_small(spark):
    """Filters on parsed columns must not be pushed into the staged rule
    projections (that multiplies the predicate; see operators/barrier.py)."""
    from pyspark.sql import functions as F

    from rostrum.operators.ages import clean_ages
    df = spark.createDataFrame([(1, "Doe, John, MD", "18+", "Min Age"), (2, "St Mary Hospital", "", None)],
                               "id int, header_col_value string, Age_Band string, header_col_name string")
    for prof, col in [("degree_caps", "firstname"), ("credential_org", "first_name"),
                      ("credential_clean", "first_name"), ("format_detect", "first_name_parsed")]:
        out = clean_names(df.drop("Age_Band"), prof, keep=["id"] if prof.startswith("degree") else None)
        assert out.filter(F.col(col).startswith("John")).count() == 1
    for prof, col in [("phrase_hdr", "min_age"), ("label_map", "min_Age"), ("simple120", "Min_Age")]:
        src = df.drop("header_col_value").withColumnRenamed("Age_Band", "header_col_value") \
            if prof != "label_map" else df
        out = clean_ages(src, prof)
        assert out.filter(F.col(col) == 18).count() == 1
