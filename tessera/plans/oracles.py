"""DuckDB SQL of the same results, put together from named parts over the stand-in entities.

RE2 knows ASCII classes only, so patterns spell classes out; after folding, the stand-in text is ASCII.
"""

from __future__ import annotations

from tessera.operators import decision, profile_a, profile_b
from tessera.plans import entities


def swap(x: str, *rules: tuple[str, str]) -> str:
    """Patterns replaced one after another."""
    for pattern, by in rules:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return x


def listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def ascii_pattern(pattern: str) -> str:
    return pattern.removeprefix("(?U)")


def general(x: str) -> str:
    folded = swap(f"lower(strip_accents({x}))", (r"\bwww\b", " "), (r"\.(com|co|in|org|net|io|edu|gov)\b", " "), *profile_a.SYMBOLS)
    return f"trim({swap(folded, ('[^a-z0-9_ ]', ' '), (' +', ' '))})"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def jaccard(a: str, b: str, empty: str = "0.0") -> str:
    either = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {either} = 0 THEN {empty} ELSE len(list_intersect({a}, {b}))::DOUBLE / {either} END"


PARTS: dict[str, str] = {}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def with_parts(sql: str) -> str:
    """The query with every part that it, or a part of it, names."""
    need: list[str] = []

    def visit(text: str) -> None:
        import re

        for name in PARTS:
            if name not in need and re.search(rf"\b{name}\b", text):
                visit(PARTS[name])
                if name not in need:
                    need.append(name)

    visit(sql)
    order = [n for n in PARTS if n in need]
    return ("WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n" if order else "") + sql


part("entities", entities.entity_sql(duck=True))
part("truth", entities.truth_sql())
part("links", "SELECT source1_entity_id AS s1_id, unnest(list_distinct(list_filter(list_transform(string_split(matched_entity_ids, ','), lambda t: trim(t)), lambda t: t <> ''))) AS tgt_id FROM truth")
part("truth_counts", "SELECT source1_entity_id AS s1_id, len(list_filter(string_split(matched_entity_ids, ','), lambda t: t <> '')) AS n_true FROM truth")

ADDRESS = f"trim({swap(general('business_address'), *((ascii_pattern(p), by) for p, by in profile_a.EXPANSIONS), (' +', ' '))})"
END, START = ascii_pattern(profile_a.LEGAL_END), ascii_pattern(profile_a.LEGAL_START)
part("a_clean", f"SELECT *, {general('business_name')} AS clean_name, {ADDRESS} AS clean_address, upper(trim(country)) AS country_clean FROM entities")
part(
    "a_form",
    f"""SELECT *, CASE WHEN regexp_extract(clean_name, '{END}', 1) <> '' THEN regexp_extract(clean_name, '{END}', 1) ELSE regexp_extract(clean_name, '{START}', 1) END AS legal_suffix,
        trim(CASE WHEN regexp_extract(clean_name, '{END}', 1) <> '' THEN regexp_replace(clean_name, '{END}', '') ELSE regexp_replace(clean_name, '{START}', '') END) AS bare FROM a_clean""",
)
part("a_core", "SELECT *, CASE WHEN starts_with(c, 'the ') AND length(c) >= 8 THEN trim(substr(c, 5)) ELSE c END AS core_name FROM (SELECT *, CASE WHEN bare <> '' THEN bare ELSE clean_name END AS c FROM a_form)")
part(
    "norm_a",
    rf"""SELECT *, array_to_string(list_sort({words("core_name")}), ' ') AS sorted_name, array_to_string(list_sort({words("clean_name")}), ' ') AS sorted_clean, replace(clean_name, ' ', '') AS compact_name,
        regexp_extract_all(clean_address, '[0-9]+') AS numeric_tokens, regexp_extract(clean_address, '\b([0-9]{{5,6}})\b', 1) AS postcode FROM a_core""",
)
part(
    "a_words",
    f"""SELECT entity_id, source, CASE WHEN country_clean = '' THEN 'UNKNOWN' ELSE country_clean END AS country_key, core_name, sorted_name, postcode, numeric_tokens[1:2] AS nums,
        list_filter({words("core_name")}, lambda w: length(w) >= 3 AND w NOT IN ('the', 'and')) AS ws,
        list_filter({words("clean_address")}, lambda w: length(w) >= 4 AND NOT regexp_full_match(w, '[0-9]+') AND w NOT IN ({listed(profile_a.SKIPPED)}))[1:2] AS place FROM norm_a""",
)
part(
    "keys_a",
    """SELECT entity_id, source, country_key, 'cn:' || core_name AS key FROM a_words WHERE length(core_name) >= 3
       UNION ALL SELECT entity_id, source, country_key, 'sn:' || sorted_name FROM a_words WHERE length(sorted_name) >= 3
       UNION ALL SELECT entity_id, source, country_key, 'np:' || ws[1] || '_' || postcode FROM a_words WHERE len(ws) > 0 AND length(postcode) >= 4
       UNION ALL SELECT entity_id, source, country_key, 'nh:' || ws[1] || '_' || unnest(nums) FROM a_words WHERE len(ws) > 0
       UNION ALL SELECT entity_id, source, country_key, '2t:' || least(ws[1], ws[2]) || '_' || greatest(ws[1], ws[2]) FROM a_words WHERE len(ws) >= 2
       UNION ALL SELECT entity_id, source, country_key, '2t:' || least(ws[1], ws[3]) || '_' || greatest(ws[1], ws[3]) FROM a_words WHERE len(ws) >= 3
       UNION ALL SELECT entity_id, source, country_key, 'an:' || p || '_' || unnest(nums) FROM (SELECT *, unnest(place) AS p FROM a_words)""",
)
part("sizes_a", "SELECT country_key, key, count(*) AS n FROM keys_a WHERE source > 1 GROUP BY ALL")


def candidates_a(k: int, most: int) -> str:
    two = lambda c: f"list_distinct(list_filter({words(c)}, lambda w: length(w) >= 2))"
    return f"""SELECT s1_id, tgt_id, pre_score, rk FROM (
        SELECT s1_id, tgt_id, pre_score, row_number() OVER (PARTITION BY s1_id ORDER BY pre_score DESC, tgt_id) AS rk FROM (
          SELECT s1_id, tgt_id, round(0.60 * ({jaccard(two("s.core_name"), two("t.core_name"))}) + 0.25 * ({jaccard(two("s.clean_address"), two("t.clean_address"))})
                 + 0.15 * CASE WHEN list_has_any(s.numeric_tokens, t.numeric_tokens) THEN 1 ELSE 0 END, 12) AS pre_score
          FROM (SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS tgt_id FROM keys_a a JOIN keys_a b ON a.country_key = b.country_key AND a.key = b.key
                JOIN sizes_a z ON z.country_key = b.country_key AND z.key = b.key WHERE a.source = 1 AND b.source > 1 AND z.n <= {most}) p
          JOIN norm_a s ON s.entity_id = s1_id JOIN norm_a t ON t.entity_id = tgt_id)) WHERE rk <= {k}"""


part("cand_a", candidates_a(20, 500))
part("cand_a_capped", candidates_a(5, 4))
part("s1_spine", "SELECT e.entity_id AS s1_id, count(c.tgt_id) AS n_candidates FROM entities e LEFT JOIN cand_a c ON c.s1_id = e.entity_id WHERE e.source = 1 GROUP BY 1")
part("found_a", "SELECT l.s1_id, count(*) AS n_true, count(c.tgt_id) AS n_hit FROM links l LEFT JOIN cand_a c USING (s1_id, tgt_id) GROUP BY 1")
part("recall_rows", "SELECT p.s1_id, n_candidates, coalesce(n_true, 0) AS n_true, coalesce(n_hit, 0) AS n_hit FROM s1_spine p LEFT JOIN found_a USING (s1_id)")

PLAIN_NAME = f"trim({swap('lower(trim(business_name))', (' *& *', ' and '), ('[^a-z0-9 ]', ' '), (' +', ' '))})"
PLAIN_ADDRESS = f"trim({swap('lower(trim(business_address))', (' *& *', ' and '), ('[^a-z0-9 ]', ' '), (' +', ' '), *profile_b.EXPANSIONS)})"
part("b_plain", f"SELECT *, lower(trim(business_name)) AS name_lower, lower(trim(business_address)) AS addr_lower, lower(trim(country)) AS country_norm, {PLAIN_NAME} AS name_punct, {PLAIN_ADDRESS} AS addr_punct FROM entities")
part("b_sets", f"SELECT *, list_sort(list_distinct({words('name_punct')})) AS ts, list_filter(list_sort(list_distinct({words('name_punct')})), lambda w: w NOT IN ({listed(profile_b.LEGAL)})) AS rest FROM b_plain")
part(
    "norm_b",
    rf"""SELECT *, replace(name_punct, ' ', '') AS name_alpha, array_to_string(ts, ' ') AS name_tokens_str, array_to_string(CASE WHEN len(rest) > 0 THEN rest ELSE ts END, ' ') AS name_core,
        array_to_string(list_filter(ts, lambda w: w IN ({listed(profile_b.LEGAL)})), ' ') AS name_suffix_str, replace(addr_punct, ' ', '') AS addr_alpha,
        coalesce(list_filter({words("addr_punct")}, lambda w: regexp_full_match(w, '[0-9]+'))[1], '') AS addr_house,
        CASE WHEN country_norm = 'us' THEN regexp_extract(business_address, '\b([0-9]{{5}}(?:-[0-9]{{4}})?)\b', 1) WHEN country_norm IN ('india', 'in') THEN regexp_extract(business_address, '\b([0-9]{{6}})\b', 1)
             WHEN country_norm IN ('france', 'fr') THEN regexp_extract(business_address, '\b([0-9]{{5}})\b', 1) ELSE regexp_extract(business_address, '\b([0-9]{{5,6}})\b', 1) END AS addr_postcode FROM b_sets""",
)
STOP = "'the','and','of','in','at','to','for','a','an','de','du','la','le','les','et','en','ki','ka','ke','aur','se'"
part("b_words", f"SELECT *, list_filter({words('name_tokens_str')}, lambda w: length(w) >= 3 AND w NOT IN ({STOP}))[1] AS strong, {words('addr_punct')} AS aw FROM norm_b")
part("b_street", "SELECT *, CASE WHEN aw[1] <> addr_house THEN aw[1] ELSE coalesce(aw[2], '') END AS street FROM b_words")
part(
    "keys_b",
    """SELECT entity_id, source, 'core:' || name_core AS key FROM b_street WHERE name_core <> ''
       UNION ALL SELECT entity_id, source, 'token_postcode:' || strong || '|' || addr_postcode FROM b_street WHERE strong IS NOT NULL AND addr_postcode <> ''
       UNION ALL SELECT entity_id, source, 'token_house:' || strong || '|' || addr_house FROM b_street WHERE strong IS NOT NULL AND addr_house <> ''
       UNION ALL SELECT entity_id, source, 'prefix:' || substr(name_alpha, 1, 8) FROM b_street WHERE length(name_alpha) >= 4
       UNION ALL SELECT entity_id, source, 'house_street:' || addr_house || '|' || street FROM b_street WHERE addr_house <> '' AND street <> ''""",
)
part("bigrams_b", "SELECT DISTINCT entity_id, source, substr(x, i, 2) AS key FROM (SELECT entity_id, source, replace(name_tokens_str, ' ', '') AS x, unnest(range(1, length(replace(name_tokens_str, ' ', '')))) AS i FROM norm_b)")
part("exact_b", "SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS tgt_id FROM keys_b a JOIN keys_b b USING (key) WHERE a.source = 1 AND b.source > 1")
part("often_b", "SELECT a.entity_id AS s1_id, b.entity_id AS tgt_id FROM bigrams_b a JOIN bigrams_b b USING (key) WHERE a.source = 1 AND b.source > 1 GROUP BY 1, 2 HAVING count(*) >= 3")
part("same_b", "SELECT s1_id, tgt_id, s.country_norm = t.country_norm AND s.country_norm <> '' AS same FROM exact_b JOIN norm_b s ON s.entity_id = s1_id JOIN norm_b t ON t.entity_id = tgt_id")

part("scored", "SELECT s1_id, tgt_id, pre_score AS proba FROM cand_a")
part("levels", "SELECT unnest([0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85]::DOUBLE[]) AS threshold")
LEVELS = {"fine": decision.FINE, "weights": decision.WEIGHTS_SWEEP, "analysis": decision.ANALYSIS, "b": decision.between(0.01, 0.99, 100)}
for _name, _values in LEVELS.items():
    part(f"levels_{_name}", f"SELECT unnest([{', '.join(f'{t!r}e0' for t in _values)}]) AS threshold")


def records(threshold: str, source: str) -> str:
    return f"""SELECT {threshold} AS threshold, c.s1_id, c.n_true, count(p.tgt_id) AS n_pred, count(l.tgt_id) AS n_hit
       FROM {source} LEFT JOIN scored p ON p.s1_id = c.s1_id AND p.proba >= {threshold} LEFT JOIN links l ON l.s1_id = p.s1_id AND l.tgt_id = p.tgt_id GROUP BY ALL"""


F05 = "CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_hit = 0 THEN 0.0 ELSE 1.25::DOUBLE * n_hit / (0.25::DOUBLE * n_true + n_pred) END"
part("at_60", f"SELECT *, ({F05})::DOUBLE AS f05 FROM ({records('0.6', 'truth_counts c')})")
part("at_all", f"SELECT *, ({F05})::DOUBLE AS f05 FROM ({records('v.threshold', 'truth_counts c CROSS JOIN levels v')})")
for _name in LEVELS:
    part(f"at_{_name}", f"SELECT *, ({F05})::DOUBLE AS f05 FROM ({records('v.threshold', f'truth_counts c CROSS JOIN levels_{_name} v')})")
part(
    "stratum_rows",
    """SELECT s1_id, country, n_true, CASE WHEN n_true = 0 THEN 'singleton' WHEN n_true <= 2 THEN 'low' WHEN n_true <= 4 THEN 'medium' ELSE 'high' END AS match_bucket
       FROM truth_counts JOIN entities ON entity_id = s1_id""",
)
part("stratum_sizes", "SELECT country || '_' || match_bucket AS stratum, count(*) AS size, min(count(*)) OVER () AS least FROM stratum_rows GROUP BY 1")
part("strata", "SELECT r.*, CASE WHEN least < 2 AND size < 5 THEN country || '_rare' ELSE z.stratum END AS stratum FROM stratum_rows r JOIN stratum_sizes z ON z.stratum = r.country || '_' || r.match_bucket")
part(
    "split_rows",
    """SELECT *, CASE WHEN row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || s1_id), s1_id) <= round(count(*) OVER (PARTITION BY stratum) * 0.2) THEN 'val' ELSE 'train' END AS part
       FROM strata""",
)
part(
    "result_lines",
    """SELECT row_number() OVER (ORDER BY nth, source1_entity_id) AS line, value FROM (
         SELECT 0 AS nth, '' AS source1_entity_id, 'source1_entity_id' || chr(9) || 'matched_entity_ids' AS value
         UNION ALL SELECT 1, source1_entity_id, CASE substr(md5(source1_entity_id), 1, 1)
            WHEN '0' THEN source1_entity_id || ' without tab' WHEN '1' THEN source1_entity_id || chr(9) || 'S2-1,S2-1' WHEN '2' THEN source1_entity_id || chr(9) || source1_entity_id
            WHEN '3' THEN source1_entity_id || chr(9) || 'X-9,S2-1' WHEN '4' THEN source1_entity_id || 'x' || chr(9) || 'S3-2' WHEN '5' THEN source1_entity_id || chr(9) || 'S2-99999999'
            ELSE source1_entity_id || chr(9) || matched_entity_ids END FROM truth
         UNION ALL SELECT 2, source1_entity_id, source1_entity_id || chr(9) FROM truth WHERE substr(md5(source1_entity_id), 1, 1) = '6')""",
)
part("result_rows", "SELECT line, value, strpos(value, chr(9)) > 0 AS tab, split_part(value, chr(9), 1) AS s1_id, CASE WHEN strpos(value, chr(9)) > 0 THEN substr(value, strpos(value, chr(9)) + 1) ELSE '' END AS rest FROM result_lines WHERE line > 1")
part("result_ids", "SELECT DISTINCT s1_id, unnest(string_split(rest, ',')) AS tgt_id FROM result_rows WHERE tab AND trim(rest) <> ''")


def finding(name: str, rows: str, column: str, n: str = "count(*)") -> str:
    return f"SELECT '{name}' AS \"check\", coalesce({n}, 0)::BIGINT AS n, coalesce(list_sort(list(DISTINCT cast({column} AS varchar)))[1:5], []) AS examples FROM ({rows})"


def findings(*parts: str) -> str:
    return "SELECT \"check\", n, array_to_string(examples, ',') AS examples FROM (" + " UNION ALL ".join(parts) + ")"
