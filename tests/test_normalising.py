"""Both profiles on worked-out rows."""

import pytest
from pyspark.sql import functions as F
from tessera.functions import arrays
from tessera.functions.text import latin_table, strip_marks, without_marks
from tessera.operators import profile_a, profile_b


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Café Étoile Société SARL", "cafe etoile societe sarl"),
        ("सुरेश एंटरप्राइज प्राइवेट लिमिटेड", "सुरेश एंटरप्राइज प्राइवेट लिमिटेड"),
        ("Barnes & Noble @ Home + Work", "barnes and noble at home plus work"),
        ("www.acme.com", "acme"),
        ("  A--B c ", "a b c"),
        (None, ""),
        ("ﬁne ½ Ⅷ", "fine 1 2 viii"),
    ],
)
def test_general(spark, text, want):
    assert one(spark, text, profile_a.general) == want


@pytest.mark.parametrize(
    ("clean", "core", "form"),
    [
        ("custom wealth services llc", "custom wealth services", "llc"),
        ("acme international pvt ltd", "acme international", "pvt ltd"),
        ("llc moncada learning center", "moncada learning center", "llc"),
        ("boulangerie des alpes sarl", "boulangerie des alpes", "sarl"),
        ("llc", "llc", "llc"),
        ("the acme", "acme", ""),
        ("the abc", "the abc", ""),
        ("", "", ""),
        ("tobacco", "tobacco", ""),
    ],
)
def test_core(spark, clean, core, form):
    assert one(spark, clean, profile_a.core_name) == core
    assert one(spark, clean, profile_a.legal_form) == form


def test_addresses(spark):
    assert one(spark, "1795 Westchester Dr., Apt. 4B, High Point, NC", profile_a.address) == "1795 westchester drive apt 4b high point nc"
    assert one(spark, "P.O. Box 12", profile_a.address) == "pobox 12"
    row = profile_a.normalise(spark.createDataFrame([("S1-1", "Starbucks Coffee", "1795 Westchester Drive, Apt 4B, High Point, NC 27262", " us ")], "entity_id string, business_name string, business_address string, country string")).first()
    assert (row.numeric_tokens, row.postcode, row.country_clean, row.sorted_name) == (["1795", "4", "27262"], "27262", "US", "coffee starbucks")


def test_native_folding_is_exact(spark):
    plain = latin_table()[2]
    every = [(chr(c),) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    for r in spark.createDataFrame(every, "x string").select("x", strip_marks(F.col("x")).alias("y"), F.col("x").rlike(plain).alias("native")).collect():
        assert r.y == without_marks(r.x)


@pytest.mark.parametrize(
    ("name", "address", "country", "want"),
    [
        ("ABC Corp & Co., LLC", "123 Main St, Springfield, IL 62701", "US", ("abc corp and co llc", "abc and", "co corp llc", "123", "62701")),
        ("Abc Corp and Company Limited", "123 Main Road, Springfield 62701", "US", ("abc corp and company limited", "abc and", "company corp limited", "123", "62701")),
        ("Sharma Pvt Ltd", "Plot 45 Industrial Area Pune 411018", "India", ("sharma pvt ltd", "sharma", "ltd pvt", "45", "411018")),
        ("Dupont SAS", "12 Rue de la Paix 75001 Paris", "France", ("dupont sas", "dupont", "sas", "12", "75001")),
        ("Café", "", "", ("caf", "caf", "", "", "")),
        ("सुरेश", None, None, ("", "", "", "", "")),
        ("Group Bank", "Ave", "fr", ("group bank", "bank group", "bank group", "", "")),
    ],
)
def test_profile_b(spark, name, address, country, want):
    row = profile_b.normalise(spark.createDataFrame([("S1-1", name, address, country)], "entity_id string, business_name string, business_address string, country string")).first()
    assert (row.name_punct, row.name_core, row.name_suffix_str, row.addr_house, row.addr_postcode) == want


def test_tokens(spark):
    assert one(spark, "a bc", arrays.bigrams) == ["ab", "bc"]
    assert one(spark, "a", arrays.bigrams) == []
    assert one(spark, "the big bank of x", arrays.strong_tokens) == ["big", "bank"]


def test_fifteen_expansions_and_ninety_words():
    assert len(profile_b.EXPANSIONS) == 15
    assert len(profile_b.FEATURES) == 27 and len(profile_a.FEATURES) == 14
    assert sorted(f for g in profile_b.GROUPS.values() for f in g) == sorted(profile_b.FEATURES)
    assert profile_b.feature_names("provenance", "name_core") == ["core_token_sort_ratio", "core_ratio", "name_alpha_ratio", "pre_score"]
