"""The position of the first rule that fires is only tested where it does not follow."""

from kinfold.operators import blocking as B

RULES = [("last_name", "gender_code"), ("birth_year", "first_name", "last_name"), ("birth_year", "first_name")]


def test_what_follows_is_not_compared(spark):
    rows = [("p1", "a", 1, "ann", "lee", "f", 1980), ("p2", "b", 2, "ann", "lee", None, 1980),
            ("p3", "c", 3, "ann", "li", "f", 1980), ("p4", "d", 1, "bob", "lee", "f", 1981)]
    schema = "profile_id string, county_desc string, n_records bigint, first_name string, last_name string, gender_code string, birth_year int"
    profiles = spark.createDataFrame(rows, schema)
    pairs = B.candidate_pairs(profiles, RULES)
    found = {(r["profile_id_l"], r["profile_id_r"]): (r["match_key"], r["n_pairs"]) for r in pairs.collect()}
    assert found == {("p1", "p4"): (0, 1), ("p1", "p2"): (1, 2), ("p1", "p3"): (2, 3), ("p2", "p3"): (2, 6)}
    one = B.candidate_pairs(profiles, [RULES[0], RULES[2]])
    plan = one.select("profile_id_l", "match_key")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan
