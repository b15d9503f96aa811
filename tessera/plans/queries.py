"""Registered queries over the driver's tables, each with DuckDB SQL where SQL can express it.

Array columns are returned as joined text and real numbers rounded, so that both engines' rows can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays, similarity
from tessera.operators import blocking, decision, model, profile_a, profile_b, profiler, split, validate
from tessera.plans import entities as stand_in
from tessera.plans.oracles import finding, findings, jaccard, with_parts, words
from tessera.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_parts(sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c, kind in df.dtypes if kind == "double"})


def flat(df: DataFrame) -> DataFrame:
    """Arrays of text as comma lists."""
    return df.withColumns({c: F.array_join(c, ",") for c, kind in df.dtypes if kind == "array<string>"})


def normal_a(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stand_in.sides(profile_a.normalise(stand_in.entities(spark, sf_dir)))


def normal_b(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stand_in.sides(profile_b.normalise(stand_in.entities(spark, sf_dir)))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stand_in.truth(spark, stand_in.entities(spark, sf_dir))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.truth_links(truth(spark, sf_dir))


def truth_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.truth_counts(truth(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of profile A with the pre-score in the place of a model's probability."""
    return blocking.candidates_a(*normal_a(spark, sf_dir)).withColumnRenamed("pre_score", "proba")


# --- sources, lists, relational basics


@query("entities", "SELECT entity_id, business_name, business_address, country, source, grp, own FROM entities")
def _(spark, sf_dir):
    return stand_in.entities(spark, sf_dir)


@query("truth_wide", "SELECT * FROM truth")
def _(spark, sf_dir):
    return truth(spark, sf_dir)


@query("truth_links", "SELECT * FROM links")
def _(spark, sf_dir):
    return links(spark, sf_dir)


@query("truth_counts", "SELECT s1_id, n_true FROM truth_counts")
def _(spark, sf_dir):
    return truth_counts(spark, sf_dir)


LISTS = "VALUES ('a', ''), ('b', ' '), ('c', 'S2-1,S3-2'), ('d', 'S2-1,,S3-2,'), ('e', ' S2-1 , S2-1 '), ('f', 'nan')"


@query(
    "id_lists",
    f"""SELECT id, array_to_string(u, '|') AS parsed, CASE WHEN trim(ids) IN ('', 'nan') THEN '' ELSE array_to_string(u, '|') END AS lenient, len(x) AS safe_count,
        CASE WHEN trim(ids) = '' THEN 0 ELSE length(ids) - length(replace(ids, ',', '')) + 1 END AS comma_count
        FROM (SELECT id, ids, x, list_filter(x, lambda e, i: list_position(x, e) = i) AS u FROM (SELECT id, ids, list_filter(list_transform(string_split(ids, ','), lambda t: trim(t)), lambda t: t <> '') AS x FROM ({LISTS}) v(id, ids)))""",
)
def _(spark, sf_dir):
    ids = F.col("ids")
    lists = spark.sql(f"SELECT * FROM {LISTS} AS v(id, ids)")
    return lists.select("id", F.array_join(tables.parsed_ids(ids), "|").alias("parsed"), F.array_join(tables.lenient_ids(ids), "|").alias("lenient"), validate.safe_count(ids).alias("safe_count"), profiler.comma_count(ids).alias("comma_count"))


@query("scan_pruned", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")


@query("scan_first_rows", "SELECT entity_id, business_name FROM entities ORDER BY entity_id LIMIT 100")
def _(spark, sf_dir):
    return tables.limited(stand_in.entities(spark, sf_dir), 100).select("entity_id", "business_name")


@query("scan_semi_join", "SELECT entity_id, business_name FROM entities WHERE entity_id IN (SELECT tgt_id FROM links)")
def _(spark, sf_dir):
    wanted = links(spark, sf_dir).select(F.col("tgt_id").alias("entity_id"))
    return tables.among(stand_in.entities(spark, sf_dir), wanted).select("entity_id", "business_name")


@query("first_column_ids", "SELECT DISTINCT s1_id AS entity_id FROM result_rows WHERE trim(value) <> ''")
def _(spark, sf_dir):
    return tables.first_column_ids(result_lines(spark, sf_dir))


@query("id_list_sorted", "SELECT entity_id AS value, row_number() OVER (ORDER BY entity_id) AS place FROM entities WHERE source = 1")
def _(spark, sf_dir):
    ids = stand_in.entities(spark, sf_dir).where("source = 1").select(F.col("entity_id").alias("value"))
    return tables.numbered(ids, "value", column="place")


@query("union_of_sources", "SELECT source, count(*) AS n FROM (SELECT source FROM entities WHERE source = 2 UNION ALL SELECT source FROM entities WHERE source = 3) GROUP BY 1")
def _(spark, sf_dir):
    every = stand_in.entities(spark, sf_dir).select("source")
    return every.where("source = 2").unionByName(every.where("source = 3")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


SETS = {"union": "UNION", "intersect": "INTERSECT", "difference": "EXCEPT"}


@query("set_operations", "SELECT op, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS op, * FROM (SELECT o_custkey FROM orders {v} SELECT c_custkey FROM customer WHERE c_acctbal > 0)" for k, v in SETS.items()) + ") GROUP BY 1")
def _(spark, sf_dir):
    a, b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    made = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "difference": a.subtract(b)}
    return validate.all_of(*(df.agg(F.lit(k).alias("op"), F.count(F.lit(1)).alias("n")) for k, df in made.items()))


@query("value_counts", "SELECT c_mktsegment AS category, count(*) AS n FROM customer GROUP BY 1")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("lookup_join", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select("o_orderkey", "c_name", "n_name")


# --- profile A

A_COLUMNS = ("entity_id", "clean_name", "core_name", "legal_suffix", "sorted_name", "sorted_clean", "compact_name", "clean_address", "numeric_tokens", "postcode", "country_clean")


@query("normalise_a", "SELECT " + ", ".join(f"array_to_string({c}, ',') AS {c}" if c == "numeric_tokens" else c for c in A_COLUMNS) + " FROM norm_a")
def _(spark, sf_dir):
    return flat(profile_a.normalise(stand_in.entities(spark, sf_dir)).select(*A_COLUMNS))


@query("blocking_keys_a", "SELECT entity_id, country_key, key FROM keys_a")
def _(spark, sf_dir):
    return profile_a.blocking_keys(profile_a.normalise(stand_in.entities(spark, sf_dir)))


@query("bucket_sizes_a", "SELECT * FROM sizes_a")
def _(spark, sf_dir):
    return blocking.bucket_sizes(profile_a.blocking_keys(normal_a(spark, sf_dir)[1]))


@query("candidates_a", "SELECT s1_id, tgt_id, round(pre_score, 6) AS pre_score, rk FROM cand_a")
def _(spark, sf_dir):
    return rounded(blocking.candidates_a(*normal_a(spark, sf_dir)))


@query("candidates_a_capped", "SELECT s1_id, tgt_id, round(pre_score, 6) AS pre_score, rk FROM cand_a_capped")
def _(spark, sf_dir):
    return rounded(blocking.candidates_a(*normal_a(spark, sf_dir), k=5, most=4))


@query("candidate_spine", "SELECT * FROM s1_spine")
def _(spark, sf_dir):
    s1, targets = normal_a(spark, sf_dir)
    return blocking.spine(s1, blocking.candidates_a(s1, targets))


@query(
    "recall_all",
    """SELECT count(*) AS total_s1, count_if(n_true = 0) AS singletons, count_if(n_true > 0) AS nonsingletons, sum(n_true)::BIGINT AS total_true_matches, sum(n_hit)::BIGINT AS retrieved_true_matches,
       round(sum(n_hit)::DOUBLE / sum(n_true), 6) AS blocking_recall, round(avg(n_candidates), 6) AS avg_candidates_per_s1, max(n_candidates) AS max_candidates_per_s1 FROM recall_rows""",
)
def _(spark, sf_dir):
    s1, targets = normal_a(spark, sf_dir)
    return rounded(blocking.recall_all(s1, blocking.candidates_a(s1, targets), links(spark, sf_dir)))


@query("recall_linked", "SELECT round(sum(n_hit)::DOUBLE / sum(n_true), 4) AS blocking_recall, round(avg(n_candidates), 2) AS avg_candidates, max(n_candidates) AS max_candidates, round(1 - sum(n_candidates)::DOUBLE / (count(*) * (SELECT count(*) FROM entities WHERE source > 1)), 6) AS reduction_ratio FROM recall_rows WHERE n_true > 0")
def _(spark, sf_dir):
    s1, targets = normal_a(spark, sf_dir)
    return rounded(blocking.recall_linked(s1, blocking.candidates_a(s1, targets), links(spark, sf_dir), targets.count))


@query(
    "sweep_k",
    """SELECT k, round((SELECT count_if(c.rk <= k)::DOUBLE / count(*) FROM links LEFT JOIN cand_a c USING (s1_id, tgt_id)), 6) AS blocking_recall,
       round((SELECT avg(least(n_candidates, k)) FROM s1_spine), 6) AS avg_candidates, (SELECT max(least(n_candidates, k)) FROM s1_spine) AS max_candidates FROM (SELECT unnest([5, 10, 15, 20]) AS k)""",
)
def _(spark, sf_dir):
    s1, targets = normal_a(spark, sf_dir)
    return rounded(blocking.sweep_k(s1, blocking.candidates_a(s1, targets), links(spark, sf_dir), (5, 10, 15, 20)))


def pairs_with_features_a(spark, sf_dir) -> DataFrame:
    s1, targets = normal_a(spark, sf_dir)
    return profile_a.features(blocking.with_records(blocking.candidates_a(s1, targets), s1, targets))


EXACT_A = [f for f in profile_a.FEATURES if f not in ("name_ratio", "name_token_sort", "name_token_set", "addr_ratio")]
TWO = lambda c, n=2: f"list_distinct(list_filter({words(c)}, lambda w: length(w) >= {n}{' AND NOT regexp_full_match(w, $$[0-9]+$$)' if n == 3 else ''}))"
EQUAL = lambda c: f"CASE WHEN s.{c} <> '' AND s.{c} = t.{c} THEN 1.0 ELSE 0.0 END"


@query(
    "features_a_exact",
    f"""SELECT s1_id, tgt_id, round(CASE WHEN s.core_name <> '' AND t.core_name <> '' THEN jaro_winkler_similarity(s.core_name, t.core_name) ELSE 0 END, 6) AS name_jaro_winkler,
       round(CASE WHEN s.core_name <> '' AND t.core_name <> '' THEN {jaccard(TWO("s.core_name"), TWO("t.core_name"))} ELSE 0 END, 6) AS name_jaccard, ({EQUAL("core_name")})::DOUBLE AS core_name_exact,
       (CASE WHEN s.legal_suffix = '' OR t.legal_suffix = '' THEN 0 WHEN s.legal_suffix = t.legal_suffix THEN 1 ELSE -1 END)::DOUBLE AS suffix_agreement,
       round(CASE WHEN s.clean_address <> '' AND t.clean_address <> '' THEN {jaccard(TWO("s.clean_address", 3), TWO("t.clean_address", 3))} ELSE 0 END, 6) AS addr_jaccard,
       (CASE WHEN s.clean_address <> '' AND t.clean_address <> '' THEN len(list_intersect({TWO("s.clean_address", 3)}, {TWO("t.clean_address", 3)})) ELSE 0 END)::DOUBLE AS common_words_count,
       (CASE WHEN list_has_any(s.numeric_tokens, t.numeric_tokens) THEN 1 ELSE 0 END)::DOUBLE AS house_num_match,
       (CASE WHEN len(s.numeric_tokens) > 0 AND len(t.numeric_tokens) > 0 AND NOT list_has_any(s.numeric_tokens, t.numeric_tokens) THEN 1 ELSE 0 END)::DOUBLE AS house_num_conflict,
       ({EQUAL("postcode")})::DOUBLE AS postcode_match, ({EQUAL("country_clean")})::DOUBLE AS country_equal
       FROM cand_a JOIN norm_a s ON s.entity_id = s1_id JOIN norm_a t ON t.entity_id = tgt_id""",
)
def _(spark, sf_dir):
    return rounded(pairs_with_features_a(spark, sf_dir).select("s1_id", "tgt_id", *EXACT_A))


@query("features_a")
def _(spark, sf_dir):
    return pairs_with_features_a(spark, sf_dir).select("s1_id", "tgt_id", *profile_a.FEATURES)


# --- profile B

B_COLUMNS = ("entity_id", "name_lower", "name_punct", "name_alpha", "name_tokens_str", "name_core", "name_suffix_str", "country_norm", "addr_lower", "addr_punct", "addr_alpha", "addr_house", "addr_postcode")


@query("normalise_b", f"SELECT {', '.join(B_COLUMNS)} FROM norm_b")
def _(spark, sf_dir):
    return profile_b.normalise(stand_in.entities(spark, sf_dir)).select(*B_COLUMNS)


@query("blocking_keys_b", "SELECT entity_id, key FROM keys_b")
def _(spark, sf_dir):
    return profile_b.exact_keys(profile_b.normalise(stand_in.entities(spark, sf_dir)))


@query("bigram_keys_b", "SELECT entity_id, key FROM bigrams_b")
def _(spark, sf_dir):
    return profile_b.bigram_keys(profile_b.normalise(stand_in.entities(spark, sf_dir)))


@query("pairs_b", "SELECT * FROM exact_b UNION SELECT * FROM often_b")
def _(spark, sf_dir):
    return blocking.pairs_b(*normal_b(spark, sf_dir))


@query("pairs_b_country", "SELECT s1_id, tgt_id FROM (SELECT *, max(same) OVER (PARTITION BY s1_id) AS any_same FROM same_b) WHERE same OR NOT any_same")
def _(spark, sf_dir):
    """Over exact keys, as its SQL is; pairs_b_country_all has the bigrams too."""
    return pairs_b_country(spark, sf_dir, bigrams=None)


@query("pairs_b_country_all")
def pairs_b_country(spark, sf_dir, bigrams=3):
    s1, targets = normal_b(spark, sf_dir)
    pairs = blocking.with_records(blocking.pairs_b(s1, targets, bigrams), s1.select("entity_id", "country_norm"), targets.select("entity_id", "country_norm"))
    return blocking.same_country(pairs).select("s1_id", "tgt_id")


@query("candidates_b")
def _(spark, sf_dir):
    return blocking.candidates_b(*normal_b(spark, sf_dir))


NATIVE_B = ("name_token_jaccard", "name_suffix_match", "addr_token_jaccard", "addr_common_token_count", "addr_s1_blank", "addr_tgt_blank", "addr_both_present", "country_equal", "name_len_ratio", "addr_len_ratio", "shared_numeric_count", "house_agree", "house_conflict", "postcode_agree", "postcode_conflict")
SET_B = lambda c: f"list_distinct({words(c)})"
DIGITS_B = lambda c: f"list_distinct(list_filter({words(c)}, lambda w: regexp_full_match(w, $$[0-9]+$$)))"
BOTH_B = "s.addr_punct <> '' AND t.addr_punct <> ''"
RATIO_B = lambda c: f"CASE WHEN length(s.{c}) > 0 AND length(t.{c}) > 0 THEN least(length(s.{c}), length(t.{c}))::DOUBLE / greatest(length(s.{c}), length(t.{c})) ELSE 0 END"
AGREE_B = lambda c, op: f"(CASE WHEN s.{c} <> '' AND t.{c} <> '' AND s.{c} {op} t.{c} THEN 1 ELSE 0 END)::DOUBLE"


@query(
    "features_b_native",
    f"""SELECT s1_id, tgt_id, round({jaccard(SET_B("s.name_punct"), SET_B("t.name_punct"), "1.0")}, 6) AS name_token_jaccard,
       (CASE WHEN list_has_any({SET_B("s.name_suffix_str")}, {SET_B("t.name_suffix_str")}) THEN 1 ELSE 0 END)::DOUBLE AS name_suffix_match,
       round(CASE WHEN {BOTH_B} THEN {jaccard(SET_B("s.addr_punct"), SET_B("t.addr_punct"), "1.0")} ELSE 0 END, 6) AS addr_token_jaccard,
       (CASE WHEN {BOTH_B} THEN len(list_intersect({SET_B("s.addr_punct")}, {SET_B("t.addr_punct")})) ELSE 0 END)::DOUBLE AS addr_common_token_count,
       (s.addr_punct = '')::INT::DOUBLE AS addr_s1_blank, (t.addr_punct = '')::INT::DOUBLE AS addr_tgt_blank, ({BOTH_B})::INT::DOUBLE AS addr_both_present, {AGREE_B("country_norm", "=")} AS country_equal,
       round({RATIO_B("name_punct")}, 6) AS name_len_ratio, round({RATIO_B("addr_punct")}, 6) AS addr_len_ratio,
       len(list_intersect({DIGITS_B("s.addr_punct")}, {DIGITS_B("t.addr_punct")}))::DOUBLE AS shared_numeric_count, {AGREE_B("addr_house", "=")} AS house_agree, {AGREE_B("addr_house", "<>")} AS house_conflict,
       {AGREE_B("addr_postcode", "=")} AS postcode_agree, {AGREE_B("addr_postcode", "<>")} AS postcode_conflict
       FROM exact_b JOIN norm_b s ON s.entity_id = s1_id JOIN norm_b t ON t.entity_id = tgt_id""",
)
def _(spark, sf_dir):
    """Over exact keys, as its SQL is; features_b_native_all has the bigrams too."""
    return features_b_native(spark, sf_dir, bigrams=None)


@query("features_b_native_all")
def features_b_native(spark, sf_dir, bigrams=3):
    s1, targets = normal_b(spark, sf_dir)
    records = tuple(df.select("entity_id", *(c.alias(name) for name, c in profile_b.parts().items())) for df in (s1, targets))
    return profile_b.native_features(blocking.pairs_b(s1, targets, bigrams, records), arrays.share_6).select("s1_id", "tgt_id", *NATIVE_B)


@query("features_b")
def _(spark, sf_dir):
    s1, targets = normal_b(spark, sf_dir)
    return profile_b.features(blocking.with_records(blocking.candidates_b(s1, targets), s1, targets)).select("s1_id", "tgt_id", *profile_b.FEATURES)


@query("token_functions_b", f"SELECT entity_id, array_to_string(list_filter({words('name_tokens_str')}, lambda w: length(w) >= 3 AND w NOT IN ('the','and','of','in','at','to','for','a','an','de','du','la','le','les','et','en','ki','ka','ke','aur','se')), ',') AS strong FROM norm_b")
def _(spark, sf_dir):
    return flat(profile_b.normalise(stand_in.entities(spark, sf_dir)).select("entity_id", arrays.strong_tokens(F.col("name_tokens_str")).alias("strong")))


@query("similarity_jaro_winkler", "SELECT s1_id, tgt_id, round(jaro_winkler_similarity(s.name_punct, t.name_punct), 6) AS similarity FROM exact_b JOIN norm_b s ON s.entity_id = s1_id JOIN norm_b t ON t.entity_id = tgt_id")
def _(spark, sf_dir):
    """Over exact keys, as its SQL is; similarity_jaro_winkler_all has the bigrams too."""
    return similarity_jaro_winkler(spark, sf_dir, bigrams=None)


@query("similarity_jaro_winkler_all")
def similarity_jaro_winkler(spark, sf_dir, bigrams=3):
    s1, targets = normal_b(spark, sf_dir)
    pairs = blocking.pairs_b(s1, targets, bigrams, (s1.select("entity_id", "name_punct"), targets.select("entity_id", "name_punct")))
    return rounded(pairs.select("s1_id", "tgt_id", similarity.jaro_winkler_of("s_name_punct", "t_name_punct").alias("similarity")))


# --- validation


def checks(df: DataFrame) -> DataFrame:
    return flat(df)


@query(
    "check_source",
    findings(
        finding("empty_key", "SELECT entity_id FROM dirty WHERE trim(entity_id) = ''", "entity_id"),
        finding("wrong_prefix", "SELECT entity_id FROM dirty WHERE NOT starts_with(entity_id, 'S2-')", "entity_id"),
        finding("duplicate_key", "SELECT entity_id, count(*) - 1 AS extra FROM dirty GROUP BY 1 HAVING count(*) > 1", "entity_id", "sum(extra)"),
    ).replace("dirty", "(SELECT CASE WHEN grp % 50 = 0 THEN '' WHEN grp % 50 = 1 THEN 'S2-1' ELSE entity_id END AS entity_id FROM entities WHERE source > 1)"),
)
def _(spark, sf_dir):
    dirty = stand_in.entities(spark, sf_dir).where("source > 1").selectExpr("CASE WHEN grp % 50 = 0 THEN '' WHEN grp % 50 = 1 THEN 'S2-1' ELSE entity_id END AS entity_id")
    return checks(validate.check_source(dirty, "S2-"))


BAD_LINKS = "SELECT s1_id, CASE substr(md5(tgt_id), 1, 1) WHEN '0' THEN 'Z' || tgt_id WHEN '1' THEN tgt_id || '0000000' ELSE tgt_id END AS tgt_id FROM {links}"
BAD_TRUTH = "SELECT CASE substr(md5(source1_entity_id), 1, 1) WHEN '0' THEN source1_entity_id || 'x' ELSE source1_entity_id END AS source1_entity_id FROM {truth}"


@query(
    "check_links",
    findings(
        finding("truth_s1_unknown", f"SELECT source1_entity_id AS s1_id FROM ({BAD_TRUTH.format(truth='truth')}) WHERE source1_entity_id NOT IN (SELECT entity_id FROM entities WHERE source = 1)", "s1_id"),
        finding("link_prefix", f"SELECT tgt_id FROM ({BAD_LINKS.format(links='links')}) WHERE tgt_id NOT LIKE 'S2-%' AND tgt_id NOT LIKE 'S3-%'", "tgt_id"),
        finding("link_s2_unknown", f"SELECT tgt_id FROM ({BAD_LINKS.format(links='links')}) WHERE tgt_id LIKE 'S2-%' AND tgt_id NOT IN (SELECT entity_id FROM entities WHERE source = 2)", "tgt_id"),
        finding("link_s3_unknown", f"SELECT tgt_id FROM ({BAD_LINKS.format(links='links')}) WHERE tgt_id LIKE 'S3-%' AND tgt_id NOT IN (SELECT entity_id FROM entities WHERE source = 3)", "tgt_id"),
        finding("warning_s1_without_truth", f"SELECT entity_id FROM entities WHERE source = 1 AND entity_id NOT IN (SELECT source1_entity_id FROM ({BAD_TRUTH.format(truth='truth')}))", "entity_id"),
    ),
)
def _(spark, sf_dir):
    every = stand_in.entities(spark, sf_dir)
    wide = truth(spark, sf_dir)
    bad_links = spark.sql(BAD_LINKS, links=tables.truth_links(wide))
    return checks(validate.check_links(bad_links, spark.sql(BAD_TRUTH, truth=wide), *(every.where(f"source = {i}") for i in (1, 2, 3))))


def parts_of(spark, sf_dir) -> DataFrame:
    countries = stand_in.entities(spark, sf_dir).where("source = 1").select(F.col("entity_id").alias("s1_id"), "country")
    return split.split(truth_counts(spark, sf_dir).join(countries, "s1_id"))


#: What is planted, by the first hex digit of a record's MD5: in both parts, in none, twice in one, with another prefix.
FIRST = "substr(md5(s1_id), 1, 1)"
ONE_IN = lambda digit: f"SELECT s1_id FROM truth_counts WHERE {FIRST} = '{digit}'"


@query("check_split", findings(finding("in_both_parts", ONE_IN("0"), "s1_id"), finding("in_no_part", f"SELECT s1_id FROM truth_counts WHERE {FIRST} IN ('1', '3')", "s1_id"), finding("duplicate_key", f"SELECT s1_id FROM truth_counts WHERE {FIRST} IN ('0', '2')", "s1_id"), finding("wrong_prefix", f"SELECT 'Z' || s1_id AS s1_id FROM truth_counts WHERE {FIRST} = '3'", "s1_id")))
def _(spark, sf_dir):
    """The split with faults planted in the records whose MD5 begins with 0 to 3; all such records are in `train`, and those of 0 in `val` too."""
    parts = parts_of(spark, sf_dir).select("s1_id", "part").withColumn("digit", F.expr(FIRST)).withColumn("entity_id", F.when(F.col("digit") == "3", F.concat(F.lit("Z"), "s1_id")).otherwise(F.col("s1_id")))
    planted = F.col("digit").isin("0", "2", "3")
    train, val = parts.where((F.col("part") == "train") | planted).where("digit <> '1'"), parts.where((F.col("part") == "val") & ~planted | (F.col("digit") == "0")).where("digit <> '1'")
    every = stand_in.entities(spark, sf_dir).where("source = 1").select("entity_id")
    return checks(validate.check_split(train.unionByName(train.where("digit = '2'")), val, every))


@query("check_merge", findings(finding("row_count_changed", "SELECT source1_entity_id FROM truth WHERE substr(md5(source1_entity_id), 1, 1) = '0'", "''"), finding("missing_country", "SELECT source1_entity_id FROM truth WHERE substr(md5(source1_entity_id), 1, 1) = '1'", "source1_entity_id")))
def _(spark, sf_dir):
    """Countries with some records twice and some missing."""
    wide = truth(spark, sf_dir)
    countries = stand_in.entities(spark, sf_dir).where("source = 1").select(F.col("entity_id").alias("source1_entity_id"), "country")
    digit = F.substring(F.md5("source1_entity_id"), 1, 1)
    countries = countries.where(digit != "1").unionByName(countries.where(digit == "0"))
    return checks(validate.check_merge(wide, wide.join(countries, "source1_entity_id", "left")))


PREDICTED = "SELECT s1_id, CASE substr(md5(tgt_id), 2, 1) WHEN '0' THEN s1_id WHEN '1' THEN tgt_id || '0' ELSE tgt_id END AS tgt_id FROM {links}"


@query(
    "check_predictions",
    findings(
        finding("s1_not_predicted", f"SELECT entity_id AS s1_id FROM entities WHERE source = 1 AND entity_id NOT IN (SELECT s1_id FROM ({PREDICTED.format(links='links')}))", "s1_id"),
        finding("predicted_s1_id", f"SELECT tgt_id FROM ({PREDICTED.format(links='links')}) WHERE tgt_id LIKE 'S1-%'", "tgt_id"),
        finding("predicted_twice", f"SELECT s1_id FROM ({PREDICTED.format(links='links')}) GROUP BY s1_id, tgt_id HAVING count(*) > 1", "s1_id"),
        finding("not_a_candidate", f"SELECT s1_id FROM ({PREDICTED.format(links='links')}) p WHERE NOT EXISTS (SELECT 1 FROM cand_a c WHERE c.s1_id = p.s1_id AND c.tgt_id = p.tgt_id)", "s1_id"),
    ),
)
def _(spark, sf_dir):
    pairs = spark.sql(PREDICTED, links=links(spark, sf_dir))
    s1, targets = normal_a(spark, sf_dir)
    return checks(validate.check_predictions(pairs, pairs.select("s1_id").distinct(), blocking.candidates_a(s1, targets), s1))


LINES = """
SELECT nth, source1_entity_id, value FROM (
  SELECT 0 AS nth, '' AS source1_entity_id, 'source1_entity_id\\tmatched_entity_ids' AS value
  UNION ALL SELECT 1, source1_entity_id, CASE substr(md5(source1_entity_id), 1, 1)
     WHEN '0' THEN source1_entity_id || ' without tab' WHEN '1' THEN source1_entity_id || '\\tS2-1,S2-1' WHEN '2' THEN source1_entity_id || '\\t' || source1_entity_id
     WHEN '3' THEN source1_entity_id || '\\tX-9,S2-1' WHEN '4' THEN source1_entity_id || 'x\\tS3-2' WHEN '5' THEN source1_entity_id || '\\tS2-99999999'
     ELSE source1_entity_id || '\\t' || matched_entity_ids END FROM {truth}
  UNION ALL SELECT 2, source1_entity_id, source1_entity_id || '\\t' FROM {truth} WHERE substr(md5(source1_entity_id), 1, 1) = '6')
"""


def result_lines(spark, sf_dir) -> DataFrame:
    """A results file with planted faults, as numbered lines."""
    made = spark.sql(LINES, truth=truth(spark, sf_dir))
    return tables.numbered(made, "nth", "source1_entity_id", "value", column="line").select("line", "value")


@query(
    "check_results_file",
    findings(
        finding("no_tab", "SELECT line FROM result_rows WHERE NOT tab AND trim(value) <> ''", "line"),
        finding("duplicate_row", "SELECT s1_id FROM result_rows WHERE tab GROUP BY 1 HAVING count(*) > 1", "s1_id"),
        finding("repeated_id", "SELECT DISTINCT s1_id FROM result_rows WHERE tab AND trim(rest) <> '' AND len(string_split(rest, ',')) > len(list_distinct(string_split(rest, ',')))", "s1_id"),
        finding("self_match", "SELECT DISTINCT tgt_id FROM result_ids WHERE tgt_id LIKE 'S1-%'", "tgt_id"),
        finding("wrong_prefix", "SELECT DISTINCT tgt_id FROM result_ids WHERE NOT regexp_matches(tgt_id, '^S[123]-')", "tgt_id"),
        finding("missing_row", "SELECT entity_id AS s1_id FROM entities WHERE source = 1 AND entity_id NOT IN (SELECT s1_id FROM result_rows WHERE tab)", "s1_id"),
        finding("unexpected_row", "SELECT DISTINCT s1_id FROM result_rows WHERE tab AND s1_id NOT IN (SELECT entity_id FROM entities WHERE source = 1)", "s1_id"),
        finding("unknown_id", "SELECT DISTINCT tgt_id FROM result_ids WHERE regexp_matches(tgt_id, '^S[23]-') AND tgt_id NOT IN (SELECT entity_id FROM entities WHERE source > 1)", "tgt_id"),
    ),
)
def _(spark, sf_dir):
    every = stand_in.entities(spark, sf_dir)
    return checks(validate.check_list_lines(result_lines(spark, sf_dir), every.where("source = 1"), every.where("source > 1")))


# --- profiling

PCT = lambda part, whole: f"round(100.0::DOUBLE * {part} / {whole}, 6)"


@query("profile_blanks", "SELECT source, count(*) AS n, " + ", ".join(f"count_if(trim({f}) = '') AS blank_{f}, {PCT(f'count_if(trim({f}) = $$$$)', 'count(*)')} AS blank_{f}_pct" for f in profiler.TEXT_FIELDS) + " FROM entities GROUP BY 1")
def _(spark, sf_dir):
    return rounded(profiler.blanks(stand_in.entities(spark, sf_dir)))


@query("profile_countries", f"SELECT source, country, count(*) AS n, {PCT('count(*)', 'sum(count(*)) OVER (PARTITION BY source)')} AS pct FROM entities GROUP BY 1, 2")
def _(spark, sf_dir):
    return rounded(profiler.countries(stand_in.entities(spark, sf_dir)))


QUARTILES = lambda x: f"min({x}) AS least, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.75) AS p75, max({x}) AS most, round(avg({x}), 6) AS mean"


@query("profile_name_lengths", f"SELECT source, country, {QUARTILES('length(business_name)')} FROM entities GROUP BY 1, 2")
def _(spark, sf_dir):
    return rounded(profiler.name_lengths(stand_in.entities(spark, sf_dir)))


@query("profile_address_lengths", f"SELECT source, country, count(x) AS n_filled, {PCT('count_if(x IS NULL)', 'count(*)')} AS blank_pct, {QUARTILES('x')} FROM (SELECT *, CASE WHEN trim(business_address) <> '' THEN length(trim(business_address)) END AS x FROM entities) GROUP BY 1, 2")
def _(spark, sf_dir):
    return rounded(profiler.address_lengths(stand_in.entities(spark, sf_dir)))


@query(
    "profile_postcodes",
    rf"""SELECT source, country, count(*) AS n, count_if(pc) AS with_postcode, {PCT("count_if(pc)", "count(*)")} AS postcode_pct, count_if(num) AS with_number, {PCT("count_if(num)", "count(*)")} AS number_pct
       FROM (SELECT *, regexp_matches(business_address, '[0-9]') AS num, CASE WHEN country IN ('US', 'France') THEN regexp_matches(business_address, '\b[0-9]{{5}}\b') WHEN country = 'India' THEN regexp_matches(business_address, '\b[0-9]{{6}}\b')
             ELSE regexp_matches(business_address, '\b[0-9]{{5,6}}\b') END AS pc FROM entities) GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return rounded(profiler.postcodes(stand_in.entities(spark, sf_dir)))


COMMAS = "CASE WHEN trim(matched_entity_ids) = '' THEN 0 ELSE length(matched_entity_ids) - length(replace(matched_entity_ids, ',', '')) + 1 END"


@query("profile_match_histogram", f"SELECT least({COMMAS}, 8)::INT AS n_matches, count(*) AS n, {PCT('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM truth GROUP BY 1")
def _(spark, sf_dir):
    return rounded(profiler.match_histogram(truth(spark, sf_dir)))


@query("profile_match_averages", f"SELECT round(avg(n), 6) AS avg_all, round(avg(n) FILTER (n > 0), 6) AS avg_linked, max(n)::INT AS most FROM (SELECT {COMMAS} AS n FROM truth)")
def _(spark, sf_dir):
    return rounded(profiler.match_averages(truth(spark, sf_dir)))


HAS2, HAS3 = "matched_entity_ids LIKE '%S2-%'", "matched_entity_ids LIKE '%S3-%'"


@query("profile_match_sources", f"SELECT count_if({HAS2} AND NOT {HAS3}) AS s2_only, count_if({HAS3} AND NOT {HAS2}) AS s3_only, count_if({HAS2} AND {HAS3}) AS both, count_if(trim(matched_entity_ids) = '') AS neither FROM truth")
def _(spark, sf_dir):
    return profiler.match_sources(truth(spark, sf_dir))


@query("profile_sharing", "SELECT count(*) AS unique_ids, count_if(tgt_id LIKE 'S2-%') AS s2_unique, coalesce(sum(n) FILTER (tgt_id LIKE 'S2-%'), 0)::BIGINT AS s2_links, count_if(tgt_id LIKE 'S3-%') AS s3_unique, coalesce(sum(n) FILTER (tgt_id LIKE 'S3-%'), 0)::BIGINT AS s3_links, count_if(n > 1) AS shared_ids, max(n) AS most_shared FROM (SELECT tgt_id, count(*) AS n FROM links GROUP BY 1)")
def _(spark, sf_dir):
    return profiler.sharing(links(spark, sf_dir))


@query("profile_other_scripts", f"SELECT source, country, count_if(x) AS n, {PCT('count_if(x)', 'count(*)')} AS pct FROM (SELECT *, strlen(business_name) <> length(business_name) AS x FROM entities) GROUP BY 1, 2")
def _(spark, sf_dir):
    return rounded(profiler.other_scripts(stand_in.entities(spark, sf_dir)))


# --- split, decision, sinks


@query("strata", "SELECT s1_id, match_bucket, stratum FROM strata")
def _(spark, sf_dir):
    return parts_of(spark, sf_dir).select("s1_id", "match_bucket", "stratum")


@query("split_sizes", "SELECT stratum, count(*) - round(count(*) * 0.2)::BIGINT AS train, round(count(*) * 0.2)::BIGINT AS val FROM strata GROUP BY 1")
def _(spark, sf_dir):
    return parts_of(spark, sf_dir).groupBy("stratum").agg(F.count_if(F.col("part") == "train").alias("train"), F.count_if(F.col("part") == "val").alias("val"))


@query(
    "split_balance",
    """SELECT stratum AS category, train, round(100.0::DOUBLE * train / sum(train) OVER (), 6) AS train_pct, val, round(100.0::DOUBLE * val / sum(val) OVER (), 6) AS val_pct,
       round(abs(100.0::DOUBLE * train / sum(train) OVER () - 100.0::DOUBLE * val / sum(val) OVER ()), 6) AS diff, abs(100.0::DOUBLE * train / sum(train) OVER () - 100.0::DOUBLE * val / sum(val) OVER ()) > 0.5 AS warn
       FROM (SELECT stratum, count(*) - round(count(*) * 0.2)::BIGINT AS train, round(count(*) * 0.2)::BIGINT AS val FROM strata GROUP BY 1)""",
)
def _(spark, sf_dir):
    return rounded(split.balance(parts_of(spark, sf_dir), "stratum"))


@query("split_parts", "SELECT s1_id, stratum, part FROM split_rows")
def _(spark, sf_dir):
    return parts_of(spark, sf_dir).select("s1_id", "stratum", "part")


@query("split_match_statistics", "SELECT part, round(avg(n_true), 6) AS mean, quantile_cont(n_true, 0.5) AS median, max(n_true)::INT AS most FROM split_rows GROUP BY 1")
def _(spark, sf_dir):
    return rounded(split.match_statistics(parts_of(spark, sf_dir)))


@query(
    "training_quota",
    """SELECT s1_id, pos AS positives, least(neg, CASE WHEN pos > 0 THEN greatest(1, 4 * pos) ELSE 2 END)::BIGINT AS negatives
       FROM (SELECT c.s1_id, count(l.tgt_id) AS pos, count(*) - count(l.tgt_id) AS neg FROM cand_a c LEFT JOIN links l USING (s1_id, tgt_id) GROUP BY 1)""",
)
def _(spark, sf_dir):
    pairs = split.training_pairs(split.labelled(scored(spark, sf_dir).select("s1_id", "tgt_id"), links(spark, sf_dir)))
    return pairs.groupBy("s1_id").agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))


@query("labelled_pairs", "SELECT c.s1_id, c.tgt_id, CASE WHEN l.tgt_id IS NULL THEN 0 ELSE 1 END AS label FROM cand_a c LEFT JOIN links l USING (s1_id, tgt_id)")
def _(spark, sf_dir):
    return split.labelled(scored(spark, sf_dir).select("s1_id", "tgt_id"), links(spark, sf_dir))


@query("records_f05", "SELECT s1_id, n_true, n_pred, n_hit, round(f05, 6) AS f05 FROM at_60")
def _(spark, sf_dir):
    return rounded(decision.scored_records(truth_counts(spark, sf_dir), links(spark, sf_dir), decision.accepted(scored(spark, sf_dir), 0.6)))


@query(
    "macro_f05",
    """SELECT round(avg(f05), 6) AS macro_f05, round(coalesce(avg(f05) FILTER (n_true = 0), 0), 6) AS singleton_f05, round(coalesce(avg(f05) FILTER (n_true > 0), 0), 6) AS linked_f05,
       count_if(f05 = 1.0) AS n_perfect, count_if(f05 = 0.0) AS n_zero FROM at_60""",
)
def _(spark, sf_dir):
    return rounded(decision.macro_f05(decision.scored_records(truth_counts(spark, sf_dir), links(spark, sf_dir), decision.accepted(scored(spark, sf_dir), 0.6))))


def swept(spark, sf_dir, thresholds=decision.COARSE) -> DataFrame:
    return decision.by_threshold(truth_counts(spark, sf_dir), links(spark, sf_dir), scored(spark, sf_dir), thresholds)


SWEPT = "SELECT round(threshold, 6) AS threshold, round(avg(f05), 6) AS macro_f05, round(100.0::DOUBLE * count_if(n_pred = 0) / count(*), 6) AS singleton_pct, sum(n_pred)::BIGINT AS n_matches FROM {rows} GROUP BY 1"
ANALYSED = """SELECT round(threshold, 3) AS threshold, round(avg(f05), 4) AS total_f05, round(coalesce(avg((n_pred = 0)::INT::DOUBLE) FILTER (n_true = 0), 0), 4) AS singleton_acc,
       round(coalesce(avg(f05) FILTER (n_true > 0), 0), 4) AS non_singleton_f05, sum(n_pred)::BIGINT AS total_predicted, sum(n_pred - n_hit)::BIGINT AS fp_count FROM {rows} GROUP BY 1"""


@query("threshold_sweep", SWEPT.format(rows="at_all"))
def _(spark, sf_dir):
    return rounded(decision.sweep(swept(spark, sf_dir)))


@query("threshold_sweep_fine", SWEPT.format(rows="at_fine"))
def _(spark, sf_dir):
    return rounded(decision.sweep(swept(spark, sf_dir, decision.FINE)))


@query("threshold_sweep_weights", SWEPT.format(rows="at_weights"))
def _(spark, sf_dir):
    return rounded(decision.sweep(swept(spark, sf_dir, decision.WEIGHTS_SWEEP)))


@query("threshold_sweep_b", SWEPT.format(rows="at_b"))
def _(spark, sf_dir):
    """The thresholds of profile B, on the pre-scores of profile A."""
    return rounded(decision.sweep(swept(spark, sf_dir, decision.between(0.01, 0.99, 100))))


@query("threshold_analysis", ANALYSED.format(rows="at_all"))
def _(spark, sf_dir):
    return decision.analysis(swept(spark, sf_dir))


@query("threshold_analysis_fine", ANALYSED.format(rows="at_analysis"))
def _(spark, sf_dir):
    return decision.analysis(swept(spark, sf_dir, decision.ANALYSIS))


@query("best_threshold", "SELECT threshold, round(score, 6) AS macro_f05 FROM (SELECT threshold, avg(f05) AS score FROM at_all GROUP BY 1) ORDER BY round(score, 12) DESC, threshold LIMIT 1")
def _(spark, sf_dir):
    return rounded(decision.sweep(swept(spark, sf_dir)).orderBy(F.desc(F.round("macro_f05", 12)), "threshold").limit(1).select("threshold", "macro_f05"))


@query("predictions", "SELECT c.s1_id, coalesce(array_to_string(list_sort(list(p.tgt_id) FILTER (p.tgt_id IS NOT NULL)), ','), '') AS matches FROM truth_counts c LEFT JOIN scored p ON p.s1_id = c.s1_id AND p.proba >= 0.6 GROUP BY 1")
def _(spark, sf_dir):
    return flat(decision.predict(truth_counts(spark, sf_dir), scored(spark, sf_dir), 0.6))


@query("target_resolution", "SELECT s1_id, tgt_id, round(proba, 6) AS proba FROM (SELECT *, row_number() OVER (PARTITION BY tgt_id ORDER BY proba DESC, s1_id DESC) AS n FROM scored WHERE proba >= 0.3) WHERE n = 1")
def _(spark, sf_dir):
    return rounded(decision.resolved(scored(spark, sf_dir), 0.3))


@query("results_matching", "SELECT c.s1_id AS source1_entity_id, coalesce(array_to_string(list_sort(list(p.tgt_id) FILTER (p.tgt_id IS NOT NULL)), ','), '') AS matched_entity_ids FROM truth_counts c LEFT JOIN scored p ON p.s1_id = c.s1_id AND p.proba >= 0.6 GROUP BY 1")
def _(spark, sf_dir):
    return sinks.match_lists(truth_counts(spark, sf_dir), decision.accepted(scored(spark, sf_dir), 0.6))


@query("results_candidates", "SELECT c.s1_id AS source1_entity_id, coalesce(array_to_string(list(p.tgt_id ORDER BY rk) FILTER (p.tgt_id IS NOT NULL), ','), '') AS candidate_entity_ids FROM truth_counts c LEFT JOIN cand_a p ON p.s1_id = c.s1_id GROUP BY 1")
def _(spark, sf_dir):
    return sinks.candidate_lists(truth_counts(spark, sf_dir), scored(spark, sf_dir))


# --- models: no SQL


@query("model_scores")
def _(spark, sf_dir):
    """A small model of profile A, fitted on the training part and applied to every candidate."""
    pairs = split.labelled(pairs_with_features_a(spark, sf_dir).select("s1_id", "tgt_id", *profile_a.FEATURES), links(spark, sf_dir))
    parts = parts_of(spark, sf_dir).select("s1_id", "part")
    train = split.training_pairs(pairs.join(parts.where("part = 'train'").select("s1_id"), "s1_id", "left_semi"))
    small = model.Settings(trees=10, depth=4, least_in_leaf=5)
    return model.scored(model.fit(train, profile_a.FEATURES, small), pairs)


FLAGSHIP = QUERIES["candidates_a"]
