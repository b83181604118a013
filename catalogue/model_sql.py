"""The linkage model in DuckDB SQL: an independent statement of what the engine computes.

Built from the same settings by templates, since SQL cannot loop over comparisons.
"""

from __future__ import annotations

from catalogue.fixture import PEOPLE_SQL
from kinfold.operators.comparison import Comparison
from kinfold.operators.training import FLOOR, Model, held_out, start_m, start_u
from kinfold.plans.match import (
    PERSON_COMPARISONS,
    PREDICT_AT,
    RECALL,
    TRAINING_RULE,
)

EM_ITERATIONS = 5
START_MODEL = Model.start(PERSON_COMPARISONS, 0.01)

_VALUES = "first_name, middle_name, last_name, full_name, birth_year, gender_code"

PROFILES_SQL = (
    PEOPLE_SQL
    + f""",
profiles AS (
  SELECT county_desc, {_VALUES}, min(unique_id) AS profile_id, count(*) AS n_records
  FROM people GROUP BY county_desc, {_VALUES}
)"""
)


def _pairs(name: str, condition: str) -> str:
    sides = ", ".join(
        f"{side}.{c} AS {c}_{end}"
        for c in ("profile_id", "county_desc", *_VALUES.split(", "))
        for side, end in (("a", "l"), ("b", "r"))
    )
    return f"""
{name} AS (
  SELECT {sides}, a.n_records * b.n_records AS n_pairs,
         CASE WHEN a.last_name = b.last_name THEN 0 ELSE 1 END AS match_key
  FROM profiles a JOIN profiles b ON a.county_desc < b.county_desc AND {condition}
)"""


def gamma_sql(c: Comparison) -> str:
    left, right = f"{c.column}_l", f"{c.column}_r"
    steps = " ".join(
        f"WHEN jaro_winkler_similarity({left}, {right}) >= {t} THEN {c.top - 1 - i}"
        for i, t in enumerate(c.thresholds)
    )
    return (
        f"CASE WHEN {left} IS NULL OR {right} IS NULL THEN -1 WHEN {left} = {right} THEN {c.top}"
        f" {steps} ELSE 0 END AS {c.gamma}"
    )


PAIRS_SQL = (
    PROFILES_SQL
    + ","
    + _pairs("pairs", "a.birth_year = b.birth_year AND a.first_name = b.first_name")
)

GAMMA_SQL = (
    PAIRS_SQL
    + f""",
gammas AS (
  SELECT profile_id_l, profile_id_r, match_key, n_pairs, county_desc_l, county_desc_r,
         gender_code_l, gender_code_r, birth_year_l, birth_year_r,
         {", ".join(gamma_sql(c) for c in PERSON_COMPARISONS)}
  FROM pairs
)"""
)

_PRIOR = f"""
prior AS (
  SELECT rule_pairs, possible_pairs, least(rule_pairs / {RECALL} / possible_pairs, 1.0) AS prior
  FROM (SELECT count(*) FILTER (a.first_name = b.first_name AND a.birth_year = b.birth_year
                                OR a.last_name = b.last_name)::DOUBLE AS rule_pairs,
               count(*)::DOUBLE AS possible_pairs
        FROM people a JOIN people b ON a.county_desc < b.county_desc)
)"""
PRIOR_SQL = PEOPLE_SQL + "," + _PRIOR

_TRAINED = [c for c in PERSON_COMPARISONS if c not in held_out(PERSON_COMPARISONS, TRAINING_RULE)]

_PATTERNS = (
    _pairs("training_pairs", "a.birth_year = b.birth_year AND a.last_name = b.last_name")
    + f""",
patterns AS (
  SELECT {", ".join(c.gamma for c in _TRAINED)}, sum(n_pairs)::BIGINT AS n_pairs
  FROM (SELECT n_pairs, {", ".join(gamma_sql(c) for c in _TRAINED)} FROM training_pairs)
  GROUP BY {", ".join(c.gamma for c in _TRAINED)}
)"""
)
PATTERNS_SQL = PROFILES_SQL + "," + _PATTERNS


def _m(c: Comparison, g: int) -> str:
    return f"m_{c.gamma}_{g}"


def _factor(c: Comparison, values: list[str]) -> str:
    steps = " ".join(f"WHEN {g} THEN greatest({v}, {FLOOR})" for g, v in enumerate(values))
    return f"CASE {c.gamma} {steps} ELSE 1.0 END"


def _em_chain() -> str:
    """One CTE per half step: shares of a pattern, then new parameters, a fixed number of times."""
    exact_weights = sum(
        START_MODEL.weights(next(c for c in PERSON_COMPARISONS if c.column == column))[-1]
        for column in TRAINING_RULE
    )
    start = ", ".join(
        f"{m!r} AS {_m(c, g)}" for c in _TRAINED for g, m in enumerate(start_m(c.top + 1))
    )
    odds = f"least(greatest(prior, {FLOOR}), 1 - {FLOOR})"
    parts = [
        f"""
em0 AS (
  SELECT 1.0 / (1.0 + pow(2.0, -(log2({odds} / (1 - {odds})) + {exact_weights!r}))) AS p, {start}
  FROM prior
)"""
    ]
    for i in range(EM_ITERATIONS):
        yes = " * ".join(
            ["p", *[_factor(c, [_m(c, g) for g in range(c.top + 1)]) for c in _TRAINED]]
        )
        no = " * ".join(
            ["(1 - p)", *[_factor(c, [repr(u) for u in start_u(c.top + 1)]) for c in _TRAINED]]
        )
        new = ", ".join(
            f"coalesce(sum(n) FILTER ({c.gamma} = {g}), 0) / sum(n) FILTER ({c.gamma} >= 0)"
            f" AS {_m(c, g)}"
            for c in _TRAINED
            for g in range(c.top + 1)
        )
        parts.append(
            f"""
share{i} AS (
  SELECT patterns.*, n_pairs * y / (y + z) AS n
  FROM (SELECT patterns.*, {yes} AS y, {no} AS z FROM patterns, em{i}) patterns
),
em{i + 1} AS (SELECT sum(n) / sum(n_pairs) AS p, {new} FROM share{i})"""
        )
    return ",".join(parts)


def _model_rows() -> str:
    rows = []
    for c in PERSON_COMPARISONS:
        for g, (m, u) in enumerate(zip(start_m(c.top + 1), start_u(c.top + 1), strict=True)):
            value = f"(SELECT {_m(c, g)} FROM em{EM_ITERATIONS})" if c in _TRAINED else repr(m)
            rows.append(f"SELECT '{c.gamma}' AS comparison, {g} AS level, {value} AS m, {u!r} AS u")
    return "\n  UNION ALL ".join(rows)


def _scored(weights: list[str], prior_weight: str, joins: str = "") -> str:
    return f"""
scored AS (
  SELECT *, 1.0 / (1.0 + pow(2.0, -match_weight)) AS match_probability
  FROM (SELECT gammas.*, {" + ".join([prior_weight, *weights])} AS match_weight FROM gammas {joins})
)"""


def score_sql(table: str, model: Model) -> str:
    """Scores under a fixed model, as literals."""
    assert table == "gammas"
    weights = [
        f"CASE {c.gamma} "
        + " ".join(f"WHEN {g} THEN {w!r}" for g, w in enumerate(model.weights(c)))
        + " ELSE 0 END"
        for c in model.comparisons
    ]
    return _scored(weights, repr(model.prior_weight()))


def _score_by_table() -> str:
    joins = " ".join(
        f"LEFT JOIN model m{i} ON m{i}.comparison = '{c.gamma}' AND m{i}.level = {c.gamma}"
        for i, c in enumerate(PERSON_COMPARISONS)
    )
    weights = [
        f"coalesce(log2(greatest(m{i}.m, {FLOOR}) / greatest(m{i}.u, {FLOOR})), 0)"
        for i in range(len(PERSON_COMPARISONS))
    ]
    return _scored(weights, "(SELECT log2(prior / (1 - prior)) FROM prior)", joins)


FLOW_SQL = (
    GAMMA_SQL
    + ","
    + _PRIOR
    + ","
    + _PATTERNS
    + ","
    + _em_chain()
    + f""",
model AS (
  {_model_rows()}
),"""
    + _score_by_table()
)

GOLDEN_SQL = (
    FLOW_SQL
    + f""",
matches AS (
  SELECT * FROM scored
  WHERE match_probability >= greatest({PREDICT_AT}, 0.93) AND gender_code_l = gender_code_r
    AND birth_year_l = birth_year_r AND gamma_last_name > 0
),
members AS (
  SELECT unique_id, profile_id FROM people JOIN profiles
    ON people.county_desc = profiles.county_desc
   {" ".join(f"AND people.{c} IS NOT DISTINCT FROM profiles.{c}" for c in _VALUES.split(", "))}
),
links AS (
  SELECT l.unique_id AS a, r.unique_id AS b
  FROM matches JOIN members l ON l.profile_id = profile_id_l JOIN members r ON r.profile_id = profile_id_r
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT unique_id AS v, unique_id AS r FROM people
  UNION SELECT reach.v, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r
),
heads AS (SELECT v AS unique_id, min(r) AS head FROM reach GROUP BY v),
golden AS (SELECT dense_rank() OVER (ORDER BY head) AS golden_id, unique_id FROM heads)"""
)

COMPONENTS_SQL = """
docs AS (SELECT doc_id, n_chars, lang FROM documents),
links AS (
  SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY n_chars, lang) AS b FROM docs
  UNION ALL
  SELECT doc_id * 3, doc_id FROM docs
  WHERE doc_id % 5 = 1 AND doc_id * 3 IN (SELECT doc_id FROM docs)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM docs
  UNION SELECT reach.v, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r
),
components AS (
  SELECT 'd_' || v AS unique_id, min('d_' || r) AS component FROM reach GROUP BY v
)"""

RANDOM_U_SQL = (
    PEOPLE_SQL
    + f""",
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5(unique_id || '|42'), unique_id) AS rk FROM people
),
random_pairs AS (
  SELECT a.birth_year AS birth_year_l, b.birth_year AS birth_year_r,
         a.gender_code AS gender_code_l, b.gender_code AS gender_code_r,
         a.last_name AS last_name_l, b.last_name AS last_name_r
  FROM ranked a JOIN ranked b ON b.rk BETWEEN a.rk + 1 AND a.rk + 5
  WHERE a.county_desc <> b.county_desc
),
random_levels AS (
  SELECT gamma_birth_year, gamma_gender_code, gamma_last_name, count(*) AS n_pairs
  FROM (SELECT {", ".join(gamma_sql(c) for c in PERSON_COMPARISONS
                          if c.gamma in ("gamma_birth_year", "gamma_gender_code", "gamma_last_name"))}
        FROM random_pairs)
  GROUP BY ALL
)"""
)

_RANDOM_GAMMAS = ("gamma_birth_year", "gamma_gender_code", "gamma_last_name")


def _pairs_of_all(partners: int, comparisons: list[Comparison]) -> str:
    """Every record with the next ones in hash order; no record is left out."""
    columns = dict.fromkeys(c.column for c in comparisons)
    sides = ", ".join(f"a.{c} AS {c}_l, b.{c} AS {c}_r" for c in columns)
    return (
        PEOPLE_SQL
        + f""",
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5(unique_id || '|42'), unique_id) AS rk FROM people
),
steps AS (SELECT unnest(range(1, {partners + 1})) AS step),
ahead AS (SELECT *, rk + step AS next_rk FROM ranked, steps),
random_pairs AS (
  SELECT {sides} FROM ahead a JOIN ranked b ON b.rk = a.next_rk
  WHERE a.county_desc <> b.county_desc
),
random_gammas AS (SELECT {", ".join(gamma_sql(c) for c in comparisons)} FROM random_pairs)"""
    )


ALL_RANDOM_PAIRS_SQL = (
    _pairs_of_all(5, [c for c in PERSON_COMPARISONS if c.gamma in _RANDOM_GAMMAS])
    + f""",
random_levels AS (
  SELECT {", ".join(_RANDOM_GAMMAS)}, count(*) AS n_pairs FROM random_gammas GROUP BY ALL
)"""
)

TRAIN_U_SQL = (
    _pairs_of_all(10, PERSON_COMPARISONS)
    + f""",
found AS (
  {" UNION ALL ".join(
      f"SELECT '{c.gamma}' AS comparison, {g} AS level,"
      f" greatest(count(*) FILTER ({c.gamma} = {g}), 0.5) AS n FROM random_gammas"
      for c in PERSON_COMPARISONS for g in range(c.top + 1))}
),
u_levels AS (
  SELECT comparison, level, n / sum(n) OVER (PARTITION BY comparison) AS u FROM found
)"""
)
