"""Stand-in entity tables over `documents`: one record for each document, in three noisy sources, with their truth.

Documents 3g, 3g + 1 and 3g + 2 stand for one business in sources 1, 2 and 3 (in some groups, for two). Names, addresses
and countries follow from hashes of g; sources 2 and 3 differ from 1 by swapped, shortened or accented words, other
legal forms and blanks, by a hash of doc_id. The same text gives the view in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.shipping import ship

STARTS = ("bar", "cel", "dor", "fen", "gal", "hol", "kir", "lum", "mer", "nov", "or", "pel", "quin", "ros", "sol", "tar")
ENDS = ("ade", "bis", "co", "dale", "er", "field", "gate", "ham", "ine", "ja", "kos", "land", "mont", "ney", "ora", "port")
LEGAL = ("llc", "Inc.", "Pvt Ltd", "SARL", "corp", "", "limited", "SA")
ROADS = ("st", "rd", "ave", "blvd", "Street", "Rue", "Dr.", "ln")
COUNTRIES = ("US", "India", "France", "")


class Dialect:
    """How one engine writes hex digits and picks from a list."""

    def __init__(self, duck: bool):
        self.duck = duck
        self.text, self.whole = ("varchar", "BIGINT") if duck else ("string", "bigint")

    def digit(self, of: str, at: int) -> str:
        hexed = f"substr(md5(cast({of} AS {self.text})), {at}, 1)"
        return f"cast('0x' || {hexed} AS int)" if self.duck else f"cast(conv({hexed}, 16, 10) AS int)"

    def pick(self, values: tuple[str, ...], index: str) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"([{listed}])[({index}) % {len(values)} + 1]" if self.duck else f"element_at(array({listed}), ({index}) % {len(values)} + 1)"

    def table(self) -> str:
        return "documents" if self.duck else "{documents}"


def entity_sql(duck: bool) -> str:
    """SQL of the view: entity_id, business_name, business_address, country, source, grp (the group), own (whether it is its own business)."""
    d = Dialect(duck)
    word = lambda at: f"{d.pick(STARTS, f'k{at}')} || {d.pick(ENDS, f'k{at + 1}')}"
    keys = ", ".join(f"{d.digit('biz', i + 1)} AS k{i}" for i in range(14))
    text, group = d.text, f"cast(floor(doc_id / 3) AS {d.whole})"
    return f"""
SELECT 'S' || cast(src AS {text}) || '-' || cast(doc_id AS {text}) AS entity_id,
       CASE WHEN v = 0 THEN w2 || ' ' || w1 || ' ' || w3
            WHEN v = 1 THEN substr(w1, 1, length(w1) - 1) || ' ' || w2 || ' ' || w3
            WHEN v = 2 THEN replace(w1, 'e', 'é') || ' ' || w2 || ' & ' || w3
            WHEN v = 3 THEN 'The ' || w1 || ' ' || w2
            WHEN v = 4 THEN 'www.' || w1 || w2 || '.com'
            ELSE upper(substr(w1, 1, 1)) || substr(w1, 2, 40) || ' ' || w2 || ' ' || w3 END
         || CASE WHEN legal = '' THEN '' ELSE ' ' || legal END AS business_name,
       CASE WHEN v2 = 0 THEN ''
            WHEN v2 = 1 THEN street || ' ' || road || ', ' || house
            WHEN v2 = 2 THEN 'Plot no ' || house || ' ' || street || ' ' || road || ' ' || zip
            ELSE house || ' ' || street || ' ' || road || ', ' || city || ' ' || zip END AS business_address,
       CASE WHEN v2 = 3 THEN '' ELSE land END AS country,
       src AS source, grp, own
FROM (SELECT doc_id, src, grp, own, v, v2, {word(0)} AS w1, {word(2)} AS w2, {word(4)} AS w3,
             {d.pick(LEGAL, "CASE WHEN src = 1 OR v < 9 THEN k6 ELSE v END")} AS legal,
             cast(1 + k7 * 16 + k8 AS {text}) AS house, {word(9)} AS street,
             {d.pick(ROADS, "k10 + src")} AS road, {word(11)} AS city,
             cast(10000 + k11 * 4096 + k12 * 256 + k13 * 16 AS {text}) AS zip,
             {d.pick(COUNTRIES, "k13")} AS land
      FROM (SELECT *, {keys} FROM (
              SELECT doc_id, cast(doc_id % 3 + 1 AS int) AS src, {group} AS grp, {d.digit(group, 20)} < 3 AS own,
                     CASE WHEN doc_id % 3 = 0 THEN 9 ELSE {d.digit("doc_id", 1)} END AS v,
                     CASE WHEN doc_id % 3 = 0 THEN 9 ELSE {d.digit("doc_id", 2)} END AS v2,
                     CASE WHEN doc_id % 3 > 0 AND {d.digit(group, 20)} < 3
                          THEN 'o' || cast(doc_id AS {text}) ELSE 'g' || cast({group} AS {text}) END AS biz
              FROM {d.table()} WHERE doc_id IS NOT NULL) AS base) AS keyed) AS named
"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.sql(entity_sql(duck=False), documents=spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id"))


def sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reference records and targets."""
    return df.where("source = 1"), df.where("source > 1")


TRUTH = """
SELECT s.entity_id AS source1_entity_id, coalesce(m.ids, '') AS matched_entity_ids
FROM (SELECT entity_id, grp FROM {entities} WHERE source = 1) AS s
LEFT JOIN (SELECT grp, {join} AS ids FROM {entities} WHERE source > 1 AND NOT own GROUP BY grp) AS m ON s.grp = m.grp
"""


def truth(spark: SparkSession, found: DataFrame) -> DataFrame:
    """source1_entity_id, matched_entity_ids."""
    return spark.sql(TRUTH.replace("{join}", "array_join(array_sort(collect_list(entity_id)), ',')"), entities=found)


def truth_sql() -> str:
    return TRUTH.replace("{join}", "array_to_string(list_sort(list(entity_id)), ',')").replace("{entities}", "entities")
