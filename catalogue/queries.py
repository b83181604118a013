"""Every operator as a query over the given tables, with its DuckDB counterpart.

``QUERIES[name]`` builds the Spark result; ``ORACLES[name]`` is SQL over the same tables.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import fixture as X
from catalogue.model_sql import (
    ALL_RANDOM_PAIRS_SQL,
    COMPONENTS_SQL,
    EM_ITERATIONS,
    FLOW_SQL,
    GAMMA_SQL,
    GOLDEN_SQL,
    PAIRS_SQL,
    PATTERNS_SQL,
    PRIOR_SQL,
    PROFILES_SQL,
    RANDOM_U_SQL,
    START_MODEL,
    TRAIN_U_SQL,
    score_sql,
)
from kinfold.functions import text as T
from kinfold.functions.similarity import jaro_winkler, letter_bits, similarity_level
from kinfold.operators import blocking as B
from kinfold.operators import clusters as C
from kinfold.operators import identity as I
from kinfold.operators import ingest_log, mapping, schema_log
from kinfold.operators.cleaning import apply_cleaning
from kinfold.operators.comparison import compare, exact, similar
from kinfold.operators.scoring import predict, score, strict_matches
from kinfold.operators.training import (
    block_patterns,
    count_patterns,
    estimate_prior,
    held_out,
    model_table,
    random_pairs,
    train_u,
)
from kinfold.operators.mapping import LINKAGE_COLUMNS
from kinfold.plans import match as M
from kinfold.plans.prepare import prepare
from kinfold.session import materialize, scratch_path
from kinfold.sources.api_pages import explode_api_records
from kinfold.sources.archives import read_archives
from kinfold.sources.delimited import POSITION, read_delimited, read_delimited_with_rejects
from kinfold.sources.files import audit_files, audit_paths, classify_files, type_priority
from kinfold.sources.json_records import read_json
from kinfold.sources.loader import read_parquet
from kinfold.sources.sinks import write_stage
from kinfold.streaming.incremental import (
    SPLIT,
    cleaned_rows,
    prepare_stream,
    start_incremental,
    start_numbered,
    with_split,
)

RUN_AT = datetime(2024, 1, 1)
RUN_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
SETTINGS = M.MatchSettings(max_iterations=EM_ITERATIONS, tolerance=0.0)

ROWS_A_FILE = 5000  # of the files that queries write and read back

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def with_sql(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


# --- cleaning -----------------------------------------------------------------------------------


@query(
    "clean_voter_records",
    with_sql(
        X.RECORDS_SQL,
        "SELECT unique_id, first_name, middle_name, last_name, gender_code, birth_year,"
        " res_city_desc, zip_code, county_desc FROM records",
    ),
)
def clean_voter_records(spark, sf_dir):
    return X.records(spark, sf_dir)


@query(
    "clean_by_rules",
    """SELECT c_custkey::VARCHAR AS c_custkey,
              try_cast(regexp_extract(c_name, '#0*([0-9]+)', 1) AS DOUBLE) AS c_name,
              lower(c_mktsegment) AS c_mktsegment_raw,
              CASE WHEN lower(c_mktsegment) <> 'machinery'
                   THEN nullif(regexp_replace(lower(c_mktsegment), '[^a-z ]', '', 'g'), '') END
                AS c_mktsegment
       FROM customer""",
)
def clean_by_rules(spark, sf_dir):
    customer = X.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lower("c_mktsegment").alias("c_mktsegment_raw")
    )
    rules = {
        "global": {"strip": True, "lowercase": True},
        "columns": {
            "c_name": {"extract_regex": "#0*([0-9]+)", "type": "numeric"},
            "c_mktsegment": {"alpha_only": True},
        },
    }
    cleaned = apply_cleaning(customer, rules)
    segment = T.null_if_token(F.col("c_mktsegment"), ["machinery"])
    return cleaned.withColumn("c_mktsegment", segment)


@query(
    "strip_and_lowercase",
    "SELECT event_id, lower(trim('  ' || event_type || chr(9) || chr(160), ' ' || chr(9) || chr(160)))"
    " AS kind FROM events",
)
def strip_and_lowercase(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.upper("event_type"), F.lit("\t\xa0"))
    return X.table(spark, sf_dir, "events").select(
        "event_id", F.lower(T.strip(padded)).alias("kind")
    )


@query(
    "null_tokens",
    "SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS kind"
    " FROM events",
)
def null_tokens(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        "event_id", T.null_if_token(F.col("event_type"), ["error", "view"]).alias("kind")
    )


@query(
    "remove_titles",
    """SELECT p_partkey,
              regexp_replace(CASE p_partkey % 4 WHEN 0 THEN 'mr ' || p_name WHEN 1 THEN 'dr dr ' || p_name
                WHEN 2 THEN 'mrs. ' || p_name ELSE 'drake ' || p_name END,
                '^(mr|mrs|ms|dr)\\s+', '') AS p_name FROM part""",
)
def remove_titles(spark, sf_dir):
    kind = F.col("p_partkey") % 4
    title = F.when(kind == 0, "mr ").when(kind == 1, "dr dr ").when(kind == 2, "mrs. ").otherwise("drake ")
    return X.table(spark, sf_dir, "part").select(
        "p_partkey", T.remove_title(F.concat(title, "p_name")).alias("p_name")
    )


@query(
    "alpha_only",
    "SELECT doc_id, nullif(regexp_replace(lower(text), '[^a-z \\t\\n\\r\\f\\v]', '', 'g'), '') AS text"
    " FROM documents",
)
def alpha_only(spark, sf_dir):
    # no-break and other wide spaces count as white space for names; this column has ASCII text
    plain = F.regexp_replace(F.lower("text"), "[^\\x00-\\x7f]", "")
    return X.table(spark, sf_dir, "documents").select("doc_id", T.alpha_only(plain).alias("text"))


@query(
    "numeric_coerce",
    """SELECT event_id, CASE WHEN event_id % 5 < 3 THEN try_cast(CASE event_id % 5
         WHEN 0 THEN value::VARCHAR WHEN 1 THEN event_id || 'e2' ELSE ' -' || event_id || ' ' END
         AS DOUBLE) END AS num FROM events""",
)
def numeric_coerce(spark, sf_dir):
    kind, number = F.col("event_id") % 5, F.col("event_id").cast("string")
    messy = (
        F.when(kind == 0, F.col("value").cast("string"))
        .when(kind == 1, F.concat(number, F.lit("e2")))
        .when(kind == 2, F.concat(F.lit(" -"), number, F.lit(" ")))
        .when(kind == 3, F.concat(F.lit("0x"), number))
        .otherwise(F.concat(number, F.lit("d")))
    )
    return X.table(spark, sf_dir, "events").select("event_id", T.to_number(messy).alias("num"))


@query(
    "extract_pattern",
    "SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS lang FROM pages",
)
def extract_pattern(spark, sf_dir):
    return X.table(spark, sf_dir, "pages").select(
        "page_id", T.extract_first(F.col("url"), "/([a-z]{2})/").alias("lang")
    )


@query(
    "normalise_people",
    with_sql(X.PEOPLE_SQL, "SELECT * FROM people"),
)
def normalise_people(spark, sf_dir):
    return X.people(spark, sf_dir)


@query(
    "collapse_white_space",
    """SELECT p_partkey, p_brand || ' ' || p_name || ' ' || p_type AS label, p_name[1] AS initial
       FROM part""",
)
def collapse_white_space(spark, sf_dir):
    messy = F.concat(F.lit(" "), F.regexp_replace("p_name", " ", " \t  "), F.lit("\n"))
    return X.table(spark, sf_dir, "part").select(
        "p_partkey",
        T.full_name(F.col("p_brand"), messy, F.col("p_type")).alias("label"),
        T.first_initial(F.col("p_name")).alias("initial"),
    )


@query(
    "null_to_empty",
    with_sql(
        X.RECORDS_SQL,
        "SELECT unique_id, coalesce(last_name, '') AS last_name, coalesce(first_name[1], '') AS initial"
        " FROM records",
    ),
)
def null_to_empty(spark, sf_dir):
    return X.records(spark, sf_dir).select(
        "unique_id",
        T.null_to_empty(F.col("last_name")).alias("last_name"),
        T.first_initial(F.col("first_name")).alias("initial"),
    )


@query(
    "names_in_several_sources",
    with_sql(
        X.RECORDS_SQL,
        """SELECT first_name, last_name, count(DISTINCT county_desc) AS county_count
           FROM records GROUP BY ALL HAVING count(DISTINCT county_desc) > 1""",
    ),
)
def names_in_several_sources(spark, sf_dir):
    counts = X.records(spark, sf_dir).groupBy("first_name", "last_name").agg(
        F.countDistinct("county_desc").alias("county_count")
    )
    return counts.where(F.col("county_count") > 1)


# --- mapping and projection ---------------------------------------------------------------------


@query(
    "apply_mapping",
    "SELECT o_orderkey AS id, o_custkey AS person, o_custkey AS payer, o_orderstatus AS"
    " o_orderpriority FROM orders",
)
def apply_mapping(spark, sf_dir):
    wanted = {
        "id": "o_orderkey",
        "person": "o_custkey",
        "payer": "o_custkey",
        "o_orderpriority": "o_orderstatus",
    }
    return mapping.apply_mapping(X.table(spark, sf_dir, "orders"), wanted)


@query("identity_mapping", "SELECT * FROM nation")
def identity_mapping(spark, sf_dir):
    nation = X.table(spark, sf_dir, "nation")
    return mapping.apply_mapping(nation)


@query(
    "select_linkage_columns",
    with_sql(
        X.RAW_SQL,
        "SELECT first_name, middle_name, last_name, gender_code, birth_year, res_city_desc,"
        " zip_code, county_desc FROM raw",
    ),
)
def select_linkage_columns(spark, sf_dir):
    return mapping.select_columns(X.raw_voters(spark, sf_dir))


@query(
    "drop_null_ids",
    "SELECT CASE WHEN event_id % 7 > 0 THEN event_id END AS unique_id, value FROM events"
    " WHERE event_id % 7 > 0",
)
def drop_null_ids(spark, sf_dir):
    some = F.when(F.col("event_id") % 7 > 0, F.col("event_id")).alias("unique_id")
    return mapping.drop_null_ids(X.table(spark, sf_dir, "events").select(some, "value"))


@query(
    "stamp_run",
    f"SELECT n_nationkey, n_name, {RUN_SQL} AS pipeline_run_timestamp FROM nation",
)
def stamp_run(spark, sf_dir):
    nation = X.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    stamped = mapping.stamp_run(nation, RUN_AT)
    return stamped.withColumn(
        "pipeline_run_timestamp", F.col("pipeline_run_timestamp").cast("timestamp_ntz")
    )


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::INT AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def union_by_name(spark, sf_dir):
    customer = X.table(spark, sf_dir, "customer")
    supplier = X.table(spark, sf_dir, "supplier")
    return mapping.union_all_by_name(
        [
            mapping.apply_mapping(
                customer, {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"}
            ),
            mapping.apply_mapping(
                supplier, {"id": "s_suppkey", "nation": "s_nationkey", "name": "s_name"}
            ),
        ]
    )


# --- ids and samples ----------------------------------------------------------------------------


@query(
    "sequential_ids",
    """SELECT source || '_' || row_number() OVER (PARTITION BY source ORDER BY doc_id) AS unique_id,
              source, doc_id FROM documents""",
)
def sequential_ids(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select("source", "doc_id")
    return I.add_sequential_ids(docs, "source", ["doc_id"])


@query(
    "hash_ids",
    """SELECT sha256(length(c_custkey::VARCHAR) || ':' || c_custkey || '|' ||
                     length(c_name) || ':' || c_name) AS unique_id, c_custkey, c_name FROM customer""",
)
def hash_ids(spark, sf_dir):
    return I.add_hash_ids(X.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))


@query(
    "uuid_ids",
    "SELECT count(*) AS n_rows, count(*) AS n_ids FROM customer",
)
def uuid_ids(spark, sf_dir):
    ids = I.add_uuid_ids(X.table(spark, sf_dir, "customer").select("c_custkey"))
    return ids.agg(
        F.count("*").alias("n_rows"), F.countDistinct("unique_id").alias("n_ids")
    )


@query(
    "sample_exactly",
    "SELECT l_orderkey || '_' || l_linenumber AS unique_id FROM lineitem"
    " ORDER BY md5(unique_id || '|42'), unique_id LIMIT 5000",
)
def sample_exactly(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("unique_id")
    )
    return I.sample_exactly(items, 5000)


@query(
    "row_cap_per_group",
    """SELECT user_id, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 10""",
)
def row_cap_per_group(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("user_id", "event_id")
    return I.keep_first_rows(events, 10, ["event_id"], ["user_id"])


# --- comparing ----------------------------------------------------------------------------------

WORD_PAIRS_SQL = """
pairs AS (
  SELECT doc_id, unnest(w[1:len(w) - 1]) AS word_l, unnest(w[2:len(w)]) AS word_r
  FROM (SELECT doc_id, string_split_regex(trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')), ' ') AS w
        FROM documents)
  WHERE len(w) >= 2
)"""


def word_pairs(spark, sf_dir):
    """All pairs of neighbouring words of every text."""
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), "[^a-z]+", " ")), " ")
    sides = [F.slice("_w", i, F.size("_w") - 1).alias(c) for i, c in ((1, "word_l"), (2, "word_r"))]
    return (
        X.table(spark, sf_dir, "documents")
        .withColumn("_w", words)
        .where(F.size("_w") >= 2)
        .select("doc_id", F.explode(F.arrays_zip(*sides)).alias("p"))
        .select("doc_id", "p.word_l", "p.word_r")
    )


@query(
    "jaro_winkler",
    with_sql(
        WORD_PAIRS_SQL,
        "SELECT doc_id, round(CASE WHEN word_l = '' OR word_r = '' THEN 0"
        " ELSE jaro_winkler_similarity(word_l, word_r) END, 6) AS similarity FROM pairs",
    ),
)
def jaro_winkler_words(spark, sf_dir):
    return word_pairs(spark, sf_dir).select(
        "doc_id", F.round(jaro_winkler("word_l", "word_r"), 6).alias("similarity")
    )


@query(
    "similarity_levels",
    with_sql(
        WORD_PAIRS_SQL,
        """SELECT doc_id, CASE WHEN word_l = word_r THEN 3
             WHEN jaro_winkler_similarity(word_l, word_r) >= 0.75 THEN 2
             WHEN jaro_winkler_similarity(word_l, word_r) >= 0.5 THEN 1 ELSE 0 END AS gamma
           FROM pairs""",
    ),
)
def similarity_levels(spark, sf_dir):
    pairs = word_pairs(spark, sf_dir)
    pairs = pairs.withColumns({"bits_l": letter_bits("word_l"), "bits_r": letter_bits("word_r")})
    level = similarity_level("word_l", "word_r", [0.5, 0.75], ("bits_l", "bits_r"))
    return pairs.select("doc_id", level.alias("gamma"))


@query(
    "exact_levels",
    """SELECT a.event_id, CASE WHEN b.event_type IS NULL THEN -1
         WHEN a.event_type = b.event_type THEN 1 ELSE 0 END AS gamma_event_type
       FROM events a LEFT JOIN events b ON b.event_id = a.event_id + 1""",
)
def exact_levels(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("event_id", "event_type")
    left = events.withColumnRenamed("event_type", "event_type_l")
    right = events.select((F.col("event_id") - 1).alias("event_id"), F.col("event_type").alias("event_type_r"))
    pairs = left.join(right, "event_id", "left")
    return compare(pairs, [exact("event_type")], ["event_id"])


# --- blocking -----------------------------------------------------------------------------------


def profiles_of(spark, sf_dir):
    return M.build_profiles(X.people(spark, sf_dir), SETTINGS)


@query(
    "fold_profiles",
    with_sql(PROFILES_SQL, "SELECT * FROM profiles"),
)
def fold_profiles(spark, sf_dir):
    columns = M.profile_columns(SETTINGS)
    return B.fold_profiles(X.people(spark, sf_dir), columns)


@query(
    "block_on_year_and_first_name",
    with_sql(
        PROFILES_SQL,
        """SELECT a.profile_id AS profile_id_l, b.profile_id AS profile_id_r,
                  a.n_records * b.n_records AS n_pairs
           FROM profiles a JOIN profiles b
             ON a.birth_year = b.birth_year AND a.first_name = b.first_name
            AND a.county_desc < b.county_desc""",
    ),
)
def block_on_year_and_first_name(spark, sf_dir):
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    pairs = B.candidate_pairs(profiles, [("birth_year", "first_name")])
    return pairs.select("profile_id_l", "profile_id_r", "n_pairs")


@query(
    "candidate_pairs_by_first_rule",
    with_sql(
        PROFILES_SQL,
        """SELECT a.profile_id AS profile_id_l, b.profile_id AS profile_id_r,
                  CASE WHEN a.last_name = b.last_name AND a.gender_code = b.gender_code THEN 0
                       WHEN a.birth_year = b.birth_year AND a.first_name = b.first_name THEN 1
                       ELSE 2 END AS match_key,
                  a.n_records * b.n_records AS n_pairs
           FROM profiles a JOIN profiles b
             ON a.county_desc < b.county_desc
            AND (a.last_name = b.last_name AND a.gender_code = b.gender_code
              OR a.birth_year = b.birth_year AND a.first_name = b.first_name
              OR a.birth_year = b.birth_year AND a.middle_name = b.middle_name)""",
    ),
)
def candidate_pairs_by_first_rule(spark, sf_dir):
    rules = [("last_name", "gender_code"), ("birth_year", "first_name"), ("birth_year", "middle_name")]
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    pairs = B.candidate_pairs(profiles, rules)
    return pairs.select("profile_id_l", "profile_id_r", "match_key", "n_pairs")


@query(
    "candidate_pairs_in_cells",
    with_sql(
        PAIRS_SQL,
        "SELECT profile_id_l, profile_id_r, match_key, n_pairs FROM pairs",
    ),
)
def candidate_pairs_in_cells(spark, sf_dir):
    """The same pairs as one join, with every block above ten profiles cut into cells."""
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    pairs = B.candidate_pairs(profiles, SETTINGS.rules, cell_rows=10)
    return pairs.select("profile_id_l", "profile_id_r", "match_key", "n_pairs")


@query(
    "compare_candidates",
    with_sql(GAMMA_SQL, "SELECT * FROM gammas"),
)
def compare_candidates(spark, sf_dir):
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    return M.compare_candidates(profiles, SETTINGS)


# --- model --------------------------------------------------------------------------------------


@query(
    "estimate_prior",
    with_sql(
        PRIOR_SQL,
        "SELECT rule_pairs, possible_pairs, round(prior, 9) AS prior FROM prior",
    ),
)
def prior(spark, sf_dir):
    found = estimate_prior(X.people(spark, sf_dir), SETTINGS.prior_rules, SETTINGS.recall)
    return found.withColumn("prior", F.round("prior", 9))


@query(
    "training_patterns",
    with_sql(PATTERNS_SQL, "SELECT * FROM patterns"),
)
def training_patterns(spark, sf_dir):
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    rule = SETTINGS.training_rule
    trained = [c for c in SETTINGS.comparisons if c not in held_out(SETTINGS.comparisons, rule)]
    return block_patterns(profiles, rule, trained)


@query(
    "train_model",
    with_sql(
        FLOW_SQL,
        "SELECT comparison, level, round(m, 6) AS m, round(u, 6) AS u FROM model",
    ),
)
def train_model(spark, sf_dir):
    people = X.people(spark, sf_dir)
    profiles = materialize(M.build_profiles(people, SETTINGS), "profiles")
    model = M.fit_model(profiles, people, SETTINGS)
    return model_table(spark, model).select(
        "comparison", "level", F.round("m", 6).alias("m"), F.round("u", 6).alias("u")
    )


@query(
    "random_pair_levels",
    with_sql(RANDOM_U_SQL, "SELECT * FROM random_levels"),
)
def random_pair_levels(spark, sf_dir):
    comparisons = [exact("birth_year"), exact("gender_code"), similar("last_name", [0.97, 0.92])]
    columns = [c.column for c in comparisons]
    pairs = random_pairs(X.people(spark, sf_dir), None, 5, columns)
    gammas = compare(pairs.withColumn("n_pairs", F.lit(1)), comparisons, ["n_pairs"])
    return count_patterns(gammas, comparisons)


@query(
    "random_pair_levels_of_all",
    with_sql(ALL_RANDOM_PAIRS_SQL, "SELECT * FROM random_levels"),
)
def random_pair_levels_of_all(spark, sf_dir):
    """The same levels; kept beside ``random_pair_levels`` under its own name."""
    comparisons = [exact("birth_year"), exact("gender_code"), similar("last_name", [0.97, 0.92])]
    columns = [c.column for c in comparisons]
    pairs = random_pairs(X.people(spark, sf_dir), None, 5, columns)
    gammas = compare(pairs.withColumn("n_pairs", F.lit(1)), comparisons, ["n_pairs"])
    return count_patterns(gammas, comparisons)


@query(
    "train_u",
    with_sql(TRAIN_U_SQL, "SELECT comparison, level, round(u, 6) AS u FROM u_levels"),
)
def learned_u(spark, sf_dir):
    model = train_u(X.people(spark, sf_dir), START_MODEL)
    return model_table(spark, model).select("comparison", "level", F.round("u", 6).alias("u"))


@query(
    "score_pairs",
    with_sql(
        GAMMA_SQL + "," + score_sql("gammas", START_MODEL),
        """SELECT profile_id_l, profile_id_r, round(match_weight, 6) AS match_weight,
                  round(match_probability, 6) AS match_probability FROM scored""",
    ),
)
def score_pairs(spark, sf_dir):
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    scored = score(M.compare_candidates(profiles, SETTINGS), START_MODEL)
    return scored.select(
        "profile_id_l",
        "profile_id_r",
        F.round("match_weight", 6).alias("match_weight"),
        F.round("match_probability", 6).alias("match_probability"),
    )


@query(
    "strict_matches",
    with_sql(
        GAMMA_SQL + "," + score_sql("gammas", START_MODEL),
        """SELECT profile_id_l, profile_id_r, match_key, n_pairs,
                  round(match_probability, 6) AS match_probability
           FROM scored WHERE match_probability >= 0.93 AND gender_code_l = gender_code_r
             AND birth_year_l = birth_year_r AND gamma_last_name > 0""",
    ),
)
def strict(spark, sf_dir):
    profiles = materialize(profiles_of(spark, sf_dir), "profiles")
    found = predict(M.compare_candidates(profiles, SETTINGS), START_MODEL, SETTINGS.predict_at)
    return strict_matches(found).select(
        "profile_id_l",
        "profile_id_r",
        "match_key",
        "n_pairs",
        F.round("match_probability", 6).alias("match_probability"),
    )


# --- entities -----------------------------------------------------------------------------------


@query(
    "connected_components",
    with_sql(
        COMPONENTS_SQL,
        "SELECT unique_id, component FROM components",
    ),
)
def connected_components(spark, sf_dir):
    """Components of a graph over the documents, with stars and chains."""
    edges, vertices = document_graph(spark, sf_dir)
    components = C.connected_components(edges)
    return C.label_vertices(vertices, components, "unique_id")


def document_graph(spark, sf_dir):
    """Documents linked to the first of the same length and language, and some to their triple."""
    docs = X.table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    vertices = docs.select(F.concat_ws("_", F.lit("d"), "doc_id").alias("unique_id"))
    heads = docs.groupBy("n_chars", "lang").agg(F.min("doc_id").alias("head"))
    to_head = docs.join(heads, ["n_chars", "lang"]).where(F.col("doc_id") > F.col("head"))
    near = docs.select((F.col("doc_id") * 3).alias("a"), F.col("doc_id").alias("b")).where(
        F.col("doc_id") % 5 == 1
    )
    near = near.join(docs.select(F.col("doc_id").alias("a")), "a", "left_semi")
    pairs = to_head.select(F.col("doc_id").alias("a"), F.col("head").alias("b")).union(near)
    edges = pairs.select(
        F.concat_ws("_", F.lit("d"), "a").alias("src"), F.concat_ws("_", F.lit("d"), "b").alias("dst")
    )
    return edges, vertices


def linked(spark, sf_dir):
    return M.match_records(X.records(spark, sf_dir), RUN_AT, SETTINGS)


def _plain_time(df: DataFrame) -> DataFrame:
    name = "pipeline_run_timestamp"
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


@query(
    "predictions",
    with_sql(
        FLOW_SQL,
        f"""SELECT profile_id_l, profile_id_r, match_key, n_pairs, gender_code_l, gender_code_r,
                   birth_year_l, birth_year_r, gamma_last_name,
                   round(match_probability, 6) AS match_probability,
                   {RUN_SQL} AS pipeline_run_timestamp
            FROM scored WHERE match_probability >= 0.92""",
    ),
)
def predictions(spark, sf_dir):
    return _plain_time(linked(spark, sf_dir).predictions).select(
        "profile_id_l",
        "profile_id_r",
        "match_key",
        "n_pairs",
        "gender_code_l",
        "gender_code_r",
        "birth_year_l",
        "birth_year_r",
        "gamma_last_name",
        F.round("match_probability", 6).alias("match_probability"),
        "pipeline_run_timestamp",
    )


@query(
    "golden_ids",
    with_sql(
        GOLDEN_SQL,
        f"""SELECT golden_id, unique_id, first_name, middle_name, last_name, gender_code, birth_year,
                   res_city_desc, zip_code, county_desc, {RUN_SQL} AS pipeline_run_timestamp
            FROM golden LEFT JOIN records USING (unique_id)""",
    ),
)
def golden_ids(spark, sf_dir):
    return _plain_time(linked(spark, sf_dir).golden)


@query(
    "sources_per_golden_id",
    with_sql(
        GOLDEN_SQL,
        """SELECT golden_id, count(DISTINCT county_desc) AS county_count
           FROM golden LEFT JOIN records USING (unique_id) GROUP BY golden_id""",
    ),
)
def sources_per_golden_id(spark, sf_dir):
    return C.count_sources(linked(spark, sf_dir).golden_ids)


@query(
    "multi_source_people",
    with_sql(
        GOLDEN_SQL
        + """,
wide AS (SELECT golden_id, count(DISTINCT county_desc) AS county_count
         FROM golden LEFT JOIN records USING (unique_id) GROUP BY golden_id
         HAVING count(DISTINCT county_desc) > 1)""",
        f"""SELECT golden_id, county_count, unique_id, first_name, middle_name, last_name,
                   gender_code, birth_year, res_city_desc, zip_code, county_desc,
                   {RUN_SQL} AS pipeline_run_timestamp
            FROM wide LEFT JOIN golden USING (golden_id) LEFT JOIN records USING (unique_id)""",
    ),
)
def multi_source_people(spark, sf_dir):
    return _plain_time(linked(spark, sf_dir).multi_source)


@query(
    "run_metrics",
    with_sql(
        GOLDEN_SQL
        + """,
sizes AS (SELECT golden_id, count(DISTINCT county_desc) AS n
          FROM golden LEFT JOIN records USING (unique_id) GROUP BY golden_id)""",
        """SELECT 'records' AS metric, count(*)::BIGINT AS value FROM records
           UNION ALL SELECT 'candidate_pairs', coalesce(sum(n_pairs), 0)::BIGINT FROM scored
             WHERE match_probability >= 0.92
           UNION ALL SELECT 'matched_pairs', coalesce(sum(n_pairs), 0)::BIGINT FROM matches
           UNION ALL SELECT 'golden_ids', count(*) FROM sizes
           UNION ALL SELECT 'multi_source_ids', count(*) FILTER (n > 1) FROM sizes""",
    ),
)
def run_metrics(spark, sf_dir):
    return linked(spark, sf_dir).metrics


# --- schema tracking ----------------------------------------------------------------------------


@query(
    "schema_snapshot",
    """SELECT 'nation' AS dataset, 1::BIGINT AS version, ordinal, "column", dtype, 3 AS column_count,
              (SELECT count(*) FROM nation) AS row_count
       FROM (VALUES (0, 'n_nationkey', 'int'), (1, 'n_name', 'string'), (2, 'n_regionkey', 'int'))
            v(ordinal, "column", dtype)""",
)
def schema_snapshot(spark, sf_dir):
    snapshot = schema_log.extract_schema(X.table(spark, sf_dir, "nation"), "nation", 1, RUN_AT)
    return snapshot.select(
        "dataset", "version", "ordinal", "column", "dtype", "column_count", "row_count"
    )


def order_versions(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    newer = orders.drop("o_orderpriority").withColumns(
        {"o_custkey": F.col("o_custkey").cast("string"), "o_channel": F.lit("web")}
    )
    return (
        schema_log.extract_schema(orders, "orders", 1, RUN_AT),
        schema_log.extract_schema(newer, "orders", 2, RUN_AT),
    )


@query(
    "latest_schema",
    """SELECT "column", dtype, version, (SELECT count(*) FROM orders) AS row_count
       FROM (VALUES ('o_orderkey', 'bigint', 2::BIGINT), ('o_custkey', 'string', 2),
              ('o_orderstatus', 'string', 2), ('o_totalprice', 'double', 2),
              ('o_orderdate', 'timestamp_ntz', 2), ('o_channel', 'string', 2)) v("column", dtype, version)""",
)
def latest_schema(spark, sf_dir):
    path = scratch_path(spark, "schemas")
    for snapshot in order_versions(spark, sf_dir):
        schema_log.register(snapshot, path)
    latest = schema_log.latest_schema(schema_log.history(spark, path), "orders")
    return latest.select("column", "dtype", "version", "row_count")


@query(
    "schema_diff",
    """SELECT * FROM (VALUES ('o_channel', 'added', NULL, 'string'),
         ('o_custkey', 'dtype changed', 'bigint', 'string'),
         ('o_orderpriority', 'removed', 'string', NULL)) v("column", change_type, old_dtype, new_dtype)""",
)
def schema_diff(spark, sf_dir):
    return schema_log.diff_schemas(*order_versions(spark, sf_dir))


# --- ingestion state ----------------------------------------------------------------------------

STATUS_SQL = """
log AS (
  SELECT 'file_' || user_id AS filename,
         'file_' || user_id || '_' || (event_id // 40) AS attempt_id, 'src' AS source,
         CASE WHEN event_type IN ('view', 'click') THEN 'in_progress'
              WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
         ts AS event_ts, event_id AS seq,
         CASE WHEN event_type IN ('purchase', 'signup') THEN (value * 100)::BIGINT END AS size_bytes,
         NULL AS checksum, CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS error
  FROM events
),
state AS (
  SELECT filename, arg_max(status, (event_ts, seq)) AS status,
         arg_max(attempt_id, (event_ts, seq)) FILTER (status <> 'failed') AS latest_attempt,
         arg_max(coalesce(size_bytes, -1), (event_ts, seq)) FILTER (status <> 'failed') AS size
  FROM log GROUP BY filename
)"""


def attempt_events(spark, sf_dir):
    kind = F.col("event_type")
    status = (
        F.when(kind.isin("view", "click"), ingest_log.STARTED)
        .when(kind == "error", ingest_log.FAILED)
        .otherwise(ingest_log.COMPLETED)
    )
    name = F.concat(F.lit("file_"), F.col("user_id").cast("string"))
    return X.table(spark, sf_dir, "events").select(
        name.alias("filename"),
        F.concat_ws("_", name, F.floor(F.col("event_id") / 40).cast("string")).alias("attempt_id"),
        F.lit("src").alias("source"),
        status.alias("status"),
        F.col("ts").alias("event_ts"),
        F.col("event_id").alias("seq"),
        F.when(kind.isin("purchase", "signup"), F.rint(F.col("value") * 100).cast("bigint")).alias(
            "size_bytes"
        ),
        F.lit(None).cast("string").alias("checksum"),
        F.when(kind == "error", F.concat(F.lit("error "), F.col("event_id").cast("string"))).alias(
            "error"
        ),
    )


@query(
    "file_states",
    with_sql(
        STATUS_SQL,
        "SELECT filename, status, latest_attempt, nullif(size, -1) AS size_bytes FROM state",
    ),
)
def file_states(spark, sf_dir):
    return ingest_log.latest_state(attempt_events(spark, sf_dir)).drop("checksum")


@query(
    "file_states_from_snapshots",
    """WITH log AS (
         SELECT 'file_' || n_chars AS filename, doc_id AS seq, doc_id % 3 = 0 AS bad,
                CASE doc_id % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'in_progress' ELSE 'completed' END AS status,
                CASE WHEN doc_id % 3 = 2 THEN n_chars ELSE -1 END AS size
         FROM documents
       )
       SELECT filename, arg_max(status, seq) AS status,
              arg_max('attempt_' || seq, seq) FILTER (NOT bad) AS latest_attempt,
              nullif(arg_max(size, seq) FILTER (NOT bad), -1) AS size_bytes
       FROM log GROUP BY filename""",
)
def file_states_from_snapshots(spark, sf_dir):
    """Documents as events, appended in four parts and compacted behind the first and the third."""
    seq = F.col("doc_id")
    status = F.when(seq % 3 == 0, ingest_log.FAILED).when(seq % 3 == 1, ingest_log.STARTED)
    none = F.lit(None).cast("string")
    events = X.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("file_"), F.col("n_chars").cast("string")).alias("filename"),
        F.concat(F.lit("attempt_"), seq.cast("string")).alias("attempt_id"),
        none.alias("source"),
        status.otherwise(ingest_log.COMPLETED).alias("status"),
        F.lit(RUN_AT).cast("timestamp").alias("event_ts"),
        seq.alias("seq"),
        F.when(seq % 3 == 2, F.col("n_chars")).alias("size_bytes"),
        none.alias("checksum"),
        none.alias("error"),
    )
    path = scratch_path(spark, "events")
    for part in range(4):
        ingest_log.append_events(events.where(F.floor(seq / ROWS_A_FILE) % 4 == part), path)
        if part in (0, 2):
            ingest_log.compact_events(spark, path)
    return ingest_log.latest_state(ingest_log.read_current(spark, path)).drop("checksum")


@query(
    "file_attempts",
    with_sql(
        STATUS_SQL,
        """SELECT attempt_id, arg_max(filename, (event_ts, seq)) AS filename, 'src' AS source,
                  arg_max(status, (event_ts, seq)) AS status,
                  max(event_ts) FILTER (status = 'in_progress') AS started_at,
                  max(event_ts) FILTER (status = 'completed') AS completed_at,
                  max(event_ts) FILTER (status = 'failed') AS failed_at,
                  max(size_bytes) AS size_bytes, max(error) AS error
           FROM log GROUP BY attempt_id""",
    ),
)
def file_attempts(spark, sf_dir):
    return ingest_log.attempts(attempt_events(spark, sf_dir)).drop("checksum")


@query(
    "attempt_log",
    """SELECT 'file_' || c_custkey AS filename,
              CASE WHEN c_acctbal >= 0 THEN 'completed' ELSE 'failed' END AS status,
              CASE WHEN c_acctbal >= 0 THEN c_custkey END AS size_bytes,
              CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS error, 1::BIGINT AS n_attempts
       FROM customer""",
)
def attempt_log(spark, sf_dir):
    """Customers as files: attempts started, then completed or failed, appended and folded."""
    path = scratch_path(spark, "events")
    files = X.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("file_"), F.col("c_custkey").cast("string")).alias("filename"),
        F.col("c_custkey").alias("size_bytes"),
        F.lit(None).cast("string").alias("checksum"),
        F.col("c_mktsegment").alias("error"),
        (F.col("c_acctbal") >= 0).alias("good"),
    )
    started = ingest_log.start_attempts(files, "landed", RUN_AT)
    ingest_log.append_events(started, path)
    ended = datetime(2024, 1, 1, 1)
    done = ingest_log.complete_attempts(started, files.where("good"), ended)
    lost = ingest_log.fail_attempts(started, files.where("NOT good"), ended)
    ingest_log.append_events(done.unionByName(lost), path)
    events = ingest_log.read_events(spark, path)
    tried = ingest_log.attempts(events).groupBy("filename").agg(
        F.max("error").alias("error"), F.count("*").alias("n_attempts")
    )
    return ingest_log.latest_state(events).join(tried, "filename").select(
        "filename", "status", "size_bytes", "error", "n_attempts"
    )


@query(
    "pending_files",
    with_sql(
        STATUS_SQL,
        """SELECT 'file_' || c_custkey AS filename FROM customer
           WHERE 'file_' || c_custkey NOT IN (SELECT filename FROM state WHERE status = 'completed'
                 AND filename NOT IN (SELECT 'file_' || s_suppkey FROM supplier WHERE s_acctbal < 0))""",
    ),
)
def pending_files(spark, sf_dir):
    name = lambda c: F.concat(F.lit("file_"), F.col(c).cast("string"))
    wanted = X.table(spark, sf_dir, "customer").select(name("c_custkey").alias("filename"))
    broken = X.table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(
        name("s_suppkey").alias("name"), F.lit(False).alias("ok")
    )
    known = wanted.select(F.col("filename").alias("name"))
    audited = known.join(broken, "name", "left").select("name", F.coalesce("ok", F.lit(True)).alias("ok"))
    return ingest_log.pending_files(wanted, attempt_events(spark, sf_dir), audited)


# --- sources and sinks --------------------------------------------------------------------------


@query(
    "classify_files",
    """SELECT page_id, file_type, CASE file_type WHEN 'csv' THEN 1 WHEN 'json' THEN 2
                WHEN 'excel' THEN 3 WHEN 'parquet' THEN 4 ELSE 99 END AS priority
       FROM (SELECT page_id, CASE WHEN url LIKE '%/' THEN NULL ELSE CASE page_id % 7 WHEN 0 THEN 'zip'
                WHEN 1 THEN 'csv' WHEN 2 THEN 'csv' WHEN 3 THEN 'json' WHEN 4 THEN 'excel'
                WHEN 5 THEN 'parquet' END END AS file_type FROM pages)""",
)
def classify(spark, sf_dir):
    ends = F.array(*[F.lit(e) for e in (".ZIP", ".csv", ".Txt", ".json", ".xls", ".parquet", ".html")])
    path = F.concat("url", F.get(ends, (F.col("page_id") % 7).cast("int")))
    files = X.table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    kinds = classify_files(files, unsupported="null")
    return kinds.select("page_id", "file_type", type_priority(F.col("file_type")).alias("priority"))


@query(
    "audit_landed_pages",
    """SELECT coalesce(p.page_id, d.doc_id) || '.html' AS name, strlen(html)::BIGINT AS size,
              sha256(html) AS sha256,
              html IS NOT NULL AND strlen(html) >= 3000 AND coalesce(sha256(html) = d.wanted, true) AS ok,
              CASE WHEN html IS NULL THEN 'missing' WHEN strlen(html) < 3000 THEN 'too small'
                   WHEN sha256(html) <> d.wanted THEN 'checksum differs' END AS reason
       FROM pages p FULL JOIN (
         SELECT doc_id, coalesce(sha256(html), 'x') AS wanted FROM documents
         LEFT JOIN (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN html ELSE url END AS html FROM pages) q
           ON q.page_id = doc_id) d ON p.page_id = d.doc_id""",
)
def audit_landed_pages(spark, sf_dir):
    pages = X.table(spark, sf_dir, "pages")
    named = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    body = F.col("html").cast("binary")
    files = pages.select(
        F.concat(F.lit("/landing/"), named).alias("path"),
        F.length(body).cast("bigint").alias("length"),
        body.alias("content"),
    )
    sums = pages.select(
        F.col("page_id").alias("doc_id"),
        F.upper(F.sha2(F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(F.col("url")), 256)).alias(
            "sha256"
        ),
    )
    expected = X.table(spark, sf_dir, "documents").select("doc_id").join(sums, "doc_id", "left")
    expected = expected.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("name"),
        F.coalesce("sha256", F.lit("x")).alias("sha256"),
    )
    return audit_files(files, expected, min_size=3000)


def fact_files(spark: SparkSession, sf_dir: str) -> str:
    """Facts of documents as text files ``facts_<i>.txt`` of consecutive ids; the path of the folder."""
    path = scratch_path(spark, "fact_files")
    root = path if "://" in path else f"file://{path.removeprefix('file:')}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        fs.create_dir(folder)
        out, current = None, None
        for batch in batches:
            for file, rows in batch.groupby("file", sort=False):
                if file != current:
                    if out is not None:
                        out.close()
                    out, current = fs.open_output_stream(f"{folder}/facts_{file}.txt"), file
                out.write(("\n".join(rows["line"]) + "\n").encode())
            yield pd.DataFrame({"rows": [len(batch)]})
        if out is not None:
            out.close()

    rows = fact_lines(spark, sf_dir).repartition("file").sortWithinPartitions("file", "doc_id")
    materialize(rows.mapInPandas(write, "rows bigint"), "written")
    return path


def fact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(",", F.col("doc_id").cast("string"), "source", "lang")
    file = F.floor(F.col("doc_id") / ROWS_A_FILE)
    return X.table(spark, sf_dir, "documents").select(file.alias("file"), "doc_id", line.alias("line"))


@query(
    "audit_fact_files",
    f"""WITH files AS (
          SELECT doc_id // {ROWS_A_FILE} AS file,
                 string_agg(concat_ws(',', doc_id::VARCHAR, source, lang) || chr(10), ''
                            ORDER BY doc_id) AS content
          FROM documents GROUP BY 1
        )
        SELECT 'facts_' || file || '.txt' AS name, strlen(content)::BIGINT AS size,
               sha256(content) AS sha256, file % 3 <> 1 AS ok,
               CASE WHEN file % 3 = 1 THEN 'checksum differs' END AS reason FROM files
        UNION ALL SELECT 'gone.txt', NULL, NULL, false, 'missing'""",
)
def audit_fact_files(spark, sf_dir):
    """Files hashed in chunks, against checksums of which a third are wrong and a third unknown."""
    path = fact_files(spark, sf_dir)
    lines = F.array_sort(F.collect_list(F.struct("doc_id", "line")))["line"]
    content = F.concat(F.array_join(lines, "\n"), F.lit("\n"))  # of ROWS_A_FILE documents
    known = fact_lines(spark, sf_dir).groupBy("file").agg(F.sha2(content.cast("binary"), 256).alias("right"))
    wanted = F.when(F.col("file") % 3 == 0, F.upper("right")).when(F.col("file") % 3 == 1, F.lit("0" * 64))
    expected = known.select(F.concat(F.lit("facts_"), "file", F.lit(".txt")).alias("name"), wanted.alias("sha256"))
    gone = spark.createDataFrame([("gone.txt", None)], expected.schema)
    return audit_paths(spark, path, expected.unionByName(gone))


@query("audit_table_files")
def audit_table_files(spark, sf_dir):
    return audit_paths(spark, f"{sf_dir}/*.parquet")


@query(
    "read_parquet_files",
    "SELECT n_nationkey, n_name, NULL::VARCHAR AS r_name FROM nation UNION ALL SELECT NULL, NULL, r_name FROM region",
)
def read_parquet_files(spark, sf_dir):
    both = read_parquet(spark, [f"{sf_dir}/nation.parquet", f"{sf_dir}/region.parquet"])
    return both.select("n_nationkey", "n_name", "r_name")


@query(
    "read_delimited_files",
    with_sql(
        X.RAW_SQL,
        "SELECT doc_id::VARCHAR AS doc_id, first_name, middle_name, last_name, gender_code,"
        " birth_year, zip_code, county_desc FROM raw",
    ),
)
def read_delimited_files(spark, sf_dir):
    """Voter rows written as tab-separated files, then sniffed and read back."""
    path = scratch_path(spark, "delimited")
    raw = X.raw_voters(spark, sf_dir).drop("dataset", "res_city_desc")
    raw.write.option("sep", "\t").option("header", True).option("escape", '"').csv(path)
    return read_delimited(spark, path)


# Documents as lines of two kinds of file: by pipes behind a preamble, or by commas in Latin-1. Some
# lines have a field too many, lack the last two, or end inside a quoted field.
FOUND = ("id", "name", "nation", "balance", "segment", "city", "note")
MESSY_SQL = f"""
messy AS (
  SELECT doc_id, doc_id // {ROWS_A_FILE} AS file, doc_id % 11 = 0 AS long, doc_id % 13 = 0 AS open,
         doc_id % 7 = 0 AS short,
         doc_id::VARCHAR AS id, source AS name, lang AS nation, (n_chars * 3)::VARCHAR AS balance,
         lang || source AS segment, 'Ciudad é' || doc_id % 50 AS city, 'n' || doc_id AS note
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY doc_id) + if(file % 2 = 0, 3, 1) AS line
  FROM messy
)"""


def messy_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """The paths of the files, each in the order of its documents."""
    path, key = scratch_path(spark, "messy"), F.col("doc_id")
    file = F.floor(key / ROWS_A_FILE)
    piped = file % 2 == 0
    city = F.concat(F.lit("Ciudad é"), (key % 50).cast("string"))
    note = F.concat(F.lit("n"), key.cast("string"))
    values = [key, F.col("source"), F.col("lang"), F.col("n_chars") * 3, F.concat("lang", "source"), city, note]
    values = F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values])
    values = F.when((key % 11 == 0) & (key % 13 != 0), F.concat(values, F.array(F.lit("more")))).when(
        (key % 7 == 0) & (key % 13 != 0), F.slice(values, 1, 5)
    ).otherwise(values)
    line = F.when(piped, F.array_join(values, "|")).otherwise(F.array_join(values, ","))
    open_end = F.when(piped, F.lit('|"open')).otherwise(F.lit(',"open'))
    line = F.when(key % 13 == 0, F.concat(line, open_end)).otherwise(line)
    docs = X.table(spark, sf_dir, "documents")
    rows = docs.select(file.alias("file"), key.alias("at"), line.alias("line"))
    heads = docs.select(file.alias("file")).distinct()
    texts = F.when(piped_file(), F.array(F.lit("voters"), F.lit("as of today"), F.lit("|".join(FOUND)))).otherwise(
        F.array(F.lit(",".join(FOUND)))
    )
    heads = heads.select("file", F.posexplode(texts).alias("at", "line"))
    heads = heads.withColumn("at", F.col("at").cast("bigint") - 3)
    ordered = rows.unionByName(heads).repartition("file").sortWithinPartitions("file", "at").drop("at")
    # Spark's CSV writer is the one that knows encodings: one column, and nothing quoted.
    plain = {"sep": "\x01", "quote": "", "encoding": "ISO-8859-1", "ignoreLeadingWhiteSpace": False}
    ordered.where(~piped_file()).write.partitionBy("file").options(**plain).csv(f"{path}/latin")
    ordered.where(piped_file()).write.partitionBy("file").text(f"{path}/pipes")
    kinds = heads.select(piped_file().alias("piped")).distinct().collect()
    return [f"{path}/{'pipes' if r.piped else 'latin'}/*" for r in kinds]


def piped_file():
    return F.col("file") % 2 == 0


@query(
    "read_messy_files",
    with_sql(
        MESSY_SQL,
        """SELECT id, name, nation, balance, segment, CASE WHEN NOT short THEN city END AS city,
                  CASE WHEN NOT short THEN note END AS note
           FROM placed WHERE NOT long AND NOT open""",
    ),
)
def read_messy_files(spark, sf_dir):
    """Preamble, pipes, Latin-1, long and short rows."""
    return read_delimited_with_rejects(spark, messy_files(spark, sf_dir))[0]


@query(
    "rejected_lines",
    with_sql(
        MESSY_SQL,
        """SELECT file, line, CASE WHEN open THEN 'open quote' ELSE 'too long' END AS reason,
                  id FROM placed WHERE long OR open""",
    ),
)
def rejected_lines(spark, sf_dir):
    """With ``read_messy_files``, every line once."""
    rejects = read_delimited_with_rejects(spark, messy_files(spark, sf_dir))[1]
    file = F.regexp_extract("file", "/file=([0-9]+)/", 1).cast("bigint")
    return rejects.select(
        file.alias("file"), "line", "reason", F.regexp_extract("text", "^[0-9]+", 0).alias("id")
    )


@query(
    "prepare_files",
    with_sql(
        X.CLEAN_SQL,
        """SELECT dataset || '_' || row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS unique_id,
                  dataset, first_name, middle_name, last_name, gender_code, birth_year, res_city_desc,
                  zip_code, county_desc FROM clean""",
    ),
)
def prepare_voters(spark, sf_dir):
    """Voter rows written as tab-separated files of one dataset each, then read and prepared."""
    path = scratch_path(spark, "voters")
    landed(X.raw_voters(spark, sf_dir), path, "csv", sep="\t", header=True, escape='"')
    rows = read_delimited(spark, path, position=True)
    dataset = F.url_decode(F.regexp_extract(POSITION[0], "/dataset=([^/]*)/", 1))
    return prepare(rows.withColumn("dataset", dataset), "dataset", POSITION)


@query(
    "read_json_lines",
    "SELECT event_id, user_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events",
)
def read_json_lines(spark, sf_dir):
    path = scratch_path(spark, "json")
    props = F.from_json("props", "k bigint").alias("props")
    X.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", props).write.json(path)
    return read_json(spark, path).select("event_id", "user_id", "event_type", F.col("props.k").alias("k"))


@query(
    "read_json_kinds",
    """SELECT doc_id, source, n_chars, NULL::BIGINT AS key, NULL::VARCHAR AS n_name FROM documents
       UNION ALL SELECT NULL, NULL, NULL, n_nationkey, n_name FROM nation""",
)
def read_json_kinds(spark, sf_dir):
    """Arrays and lines of documents, and an object per nation; the arrays are split into records."""
    path = scratch_path(spark, "json")
    file = F.floor(F.col("doc_id") / ROWS_A_FILE).alias("file")
    docs = X.table(spark, sf_dir, "documents").select(file, "doc_id", "source", "n_chars")
    lines = F.col("doc_id") % 2 == 0
    docs.where(lines).write.json(f"{path}/lines")
    arrays = docs.where(~lines)
    ends = arrays.groupBy("file").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    record = F.to_json(F.struct("doc_id", "source", "n_chars"))
    opens = F.when(F.col("doc_id") == F.col("first"), "[").otherwise(",")
    closes = F.when(F.col("doc_id") == F.col("last"), "]").otherwise("")
    texts = arrays.join(ends, "file").select("file", "doc_id", F.concat(opens, record, closes).alias("value"))
    # Written first: a repartition right behind a join by the same column is left out, and a skewed
    # partition of the join may be split, but an array is one file.
    texts = materialize(texts, "texts").repartition("file").sortWithinPartitions("file", "doc_id")
    texts.drop("doc_id").write.partitionBy("file").text(f"{path}/arrays")
    nation = X.table(spark, sf_dir, "nation").withColumn("file", F.col("n_nationkey"))
    nation = nation.select("file", F.col("n_nationkey").alias("key"), F.struct("n_name").alias("n"))
    nation.repartition("file").write.partitionBy("file").json(f"{path}/objects")
    found = read_json(spark, [f"{path}/arrays/*", f"{path}/lines", f"{path}/objects/*"], split_over=0)
    return found.select("doc_id", "source", "n_chars", "key", F.col("`n.n_name`").alias("n_name"))


@query(
    "read_archives",
    "SELECT doc_id::VARCHAR AS id, source AS name, lang AS segment FROM documents",
)
def read_document_archives(spark, sf_dir):
    """Documents' facts packed into archives of a CSV, a JSON and a Parquet member, then read by member."""
    path = scratch_path(spark, "archives")
    root = path if "://" in path else f"file://{path.removeprefix('file:')}"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        fs.create_dir(folder)
        for batch in batches:
            batch = batch.astype(str).set_axis(["id", "name", "segment"], axis=1)
            parts = [batch[i::3] for i in range(3)]
            columns = io.BytesIO()
            parts[2].to_parquet(columns, index=False)
            name = f"{folder}/{batch['id'].iloc[0]}.zip"  # the same whenever the task runs
            with fs.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("part/documents.csv", parts[0].to_csv(index=False))
                z.writestr("documents.json", parts[1].to_json(orient="records"))
                z.writestr("documents.parquet", columns.getvalue())
                z.writestr(".hidden.csv", "id,name,segment\n-1,no,no\n")
                z.writestr("readme.md", "not a table")
            yield pd.DataFrame({"rows": [len(batch)]})

    docs = X.table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    materialize(docs.mapInPandas(pack, "rows bigint"), "packed")
    return read_archives(spark, path)


PAGES_SQL = "SELECT event_id, '{\"k\":' || regexp_extract(props, '([0-9]+)', 1) || '}' AS record FROM events"


@query(
    "explode_api_records",
    f"""SELECT event_id, record FROM ({PAGES_SQL}) WHERE event_id % 4 < 3
        UNION ALL SELECT event_id, record FROM ({PAGES_SQL}) WHERE event_id % 4 < 2
        UNION ALL SELECT event_id, record FROM ({PAGES_SQL}) WHERE event_id % 4 = 3""",
)
def explode_records(spark, sf_dir):
    """Event properties wrapped as responses: a list, two kinds of envelope, a lone object."""
    kind, props = F.col("event_id") % 4, F.col("props")
    body = (
        F.when(kind == 0, F.concat(F.lit("["), props, F.lit(","), props, F.lit("]")))
        .when(kind == 1, F.concat(F.lit('{"next":1,"results":['), props, F.lit(","), props, F.lit("]}")))
        .when(kind == 2, F.concat(F.lit('{"results":7,"items":['), props, F.lit("]}")))
        .otherwise(props)
    )
    pages = X.table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return explode_api_records(pages)


@query("write_stage_once", "SELECT s_suppkey, s_name FROM supplier")
def write_stage_once(spark, sf_dir):
    path = scratch_path(spark, "once")
    supplier = X.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    write_stage(supplier, path)
    return write_stage(supplier.where("s_suppkey < 0"), path)


# --- streaming ----------------------------------------------------------------------------------


def _hashed(column: str) -> str:
    """A value as the hashed ids see it."""
    return f"coalesce(length({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def landed(raw: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Raw rows as files of one dataset each, in the order of ``doc_id``, below ``path``."""
    rows = raw.repartitionByRange("dataset", "doc_id").sortWithinPartitions("dataset", "doc_id")
    rows.write.mode("append").partitionBy("dataset").options(**options).format(fmt).save(path)


ARRIVALS_SQL = """
arrivals AS (
  SELECT dataset || '_' || row_number() OVER (PARTITION BY dataset ORDER BY arrival, doc_id) AS unique_id,
         clean.*
  FROM clean, (VALUES (1), (2)) a(arrival)
)"""
# The people of the two arrivals in place of those of the documents.
ARRIVED_GOLDEN_SQL = GOLDEN_SQL.replace(X.RECORDS_SQL.removeprefix(X.CLEAN_SQL), f""",{ARRIVALS_SQL},
records AS (SELECT * EXCLUDE (doc_id, dataset) FROM arrivals)""")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of files, the second with copies of all rows of the first, prepared as a stream.

    A third run finds nothing new.
    """
    landing, out, ledger, state = (
        scratch_path(spark, name) for name in ("landing", "stream", "ledger", "state")
    )
    raw = materialize(X.raw_voters(spark, sf_dir), "raw")  # texts are split once, not per arrival and sort
    schema = raw.schema
    for arriving in (True, True, False):
        if arriving:
            landed(raw, landing)
        stream = with_split(spark.readStream.schema(schema).parquet(landing))
        rows = cleaned_rows(stream, ("dataset", *SPLIT))
        start_numbered(rows, out, ledger, state).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query(
    "incremental_preparation",
    with_sql(
        f"{X.CLEAN_SQL},{ARRIVALS_SQL}",
        f"SELECT unique_id, dataset, {', '.join(LINKAGE_COLUMNS)} FROM arrivals",
    ),
)
def incremental_preparation(spark, sf_dir):
    return arrivals(spark, sf_dir)


@query(
    "golden_ids_of_arrivals",
    with_sql(
        ARRIVED_GOLDEN_SQL,
        f"""SELECT golden_id, unique_id, first_name, middle_name, last_name, gender_code, birth_year,
                   res_city_desc, zip_code, county_desc, {RUN_SQL} AS pipeline_run_timestamp
            FROM golden LEFT JOIN records USING (unique_id)""",
    ),
)
def golden_ids_of_arrivals(spark, sf_dir):
    """Rows that arrive as a stream, exact copies among them, to golden ids; every row is kept."""
    records = M.load_records([arrivals(spark, sf_dir).drop("dataset")], RUN_AT, SETTINGS)
    return _plain_time(M.match_records(records, RUN_AT, SETTINGS).golden)


@query(
    "hashed_preparation",
    with_sql(
        X.CLEAN_SQL,
        f"""SELECT sha256(concat_ws('|', {", ".join(_hashed(c) for c in ("dataset", *LINKAGE_COLUMNS))}))
                     AS unique_id, dataset, {", ".join(LINKAGE_COLUMNS)} FROM clean""",
    ),
)
def hashed_preparation(spark, sf_dir):
    """The documents as a stream of files, with hashed ids; a second run finds nothing new."""
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    docs = X.table(spark, sf_dir, "documents")
    for _ in range(2):
        # a pattern matches the table whether it is one file or a folder of files
        stream = spark.readStream.schema(docs.schema).parquet(f"{sf_dir}/documents.parque[t]")
        query = start_incremental(prepare_stream(X.voters_of(stream)), out, state)
        query.awaitTermination()
    return spark.read.parquet(out)
