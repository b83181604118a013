"""Record linkage from prepared records to golden ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import text as T
from kinfold.operators.blocking import (
    CELL_ROWS,
    Rule,
    candidate_pairs,
    fold_profiles,
    widest_rules,
)
from kinfold.operators.clusters import (
    attach_records,
    connected_components,
    golden_table,
    run_metrics,
    spread_components,
)
from kinfold.operators.comparison import (
    Comparison,
    compare,
    compared_columns,
    exact,
    similar,
)
from kinfold.operators.compared_pairs import compared_block
from kinfold.operators.entities import (
    can_enumerate,
    fold_groups,
    group_edges,
    idle_comparisons,
    spread_groups,
    twins_match,
)
from kinfold.operators.identity import sample_exactly
from kinfold.operators.mapping import drop_null_ids, stamp_run, union_all_by_name
from kinfold.operators.scoring import is_strict, predict, strict_matches
from kinfold.operators.training import Model, estimate_prior, train_m, train_u
from kinfold.session import materialize

# Comparisons, rules and thresholds of the standard person match.
PERSON_COMPARISONS = (
    similar("first_name", [0.95, 0.90]),
    similar("middle_name", [0.90]),
    exact("last_name", name="last_name_exact"),
    similar("last_name", [0.97, 0.92]),
    similar("full_name", [0.92]),
    exact("birth_year"),
    exact("gender_code"),
)
PERSON_RULES = (("birth_year", "first_name", "last_name"), ("birth_year", "first_name"))
PRIOR_RULES = (("first_name", "birth_year"), ("last_name",))
TRAINING_RULE = ("birth_year", "last_name")
RECALL = 0.7
PREDICT_AT = 0.92
MATCH_AT = 0.93


@dataclass(frozen=True)
class MatchSettings:
    comparisons: tuple[Comparison, ...] = PERSON_COMPARISONS
    rules: tuple[Rule, ...] = PERSON_RULES
    prior_rules: tuple[Rule, ...] = PRIOR_RULES
    training_rule: Rule = TRAINING_RULE
    recall: float = RECALL
    predict_at: float = PREDICT_AT
    match_at: float = MATCH_AT
    source: str = "county_desc"
    id_col: str = "unique_id"
    equal: tuple[str, ...] = ("gender_code", "birth_year")
    alike: str = "gamma_last_name"
    empty_as_null: bool = True
    learn_u: bool = False
    u_records: int | None = None  # records that u is learned from; None: all
    u_partners: int = 10  # random partners of each
    max_iterations: int = 25
    tolerance: float = 1e-4
    sample_size: int | None = None
    cell_rows: int = CELL_ROWS


def normalise_people(records: DataFrame, empty_as_null: bool = True) -> DataFrame:
    """Lower-case names, full name, first initial and a 16-bit birth year.

    With ``empty_as_null`` a missing name stays null and compares as unknown; without it a missing
    name is an empty string, and two missing names are equal.
    """
    names = ("first_name", "middle_name", "last_name")
    named = records.withColumns({c: T.null_to_empty(F.lower(F.col(c))) for c in names})
    named = named.withColumns(
        {
            "full_name": T.full_name(*[F.col(c) for c in names]),
            "first_initial": T.first_initial(F.col("first_name")),
            "birth_year": T.to_short_year(F.col("birth_year")),
        }
    )
    if empty_as_null:
        named = named.withColumns({c: T.empty_to_null(F.col(c)) for c in (*names, "full_name")})
    return named


def load_records(
    frames: Sequence[DataFrame], run_at: datetime, settings: MatchSettings = MatchSettings()
) -> DataFrame:
    """Consolidate prepared datasets: rows without id dropped, optionally sampled, stamped."""
    records = drop_null_ids(union_all_by_name(list(frames)), settings.id_col)
    if settings.sample_size is not None:
        records = sample_exactly(records, settings.sample_size, id_col=settings.id_col)
    return stamp_run(records, run_at)


def profile_columns(settings: MatchSettings) -> list[str]:
    rules = [*settings.rules, *settings.prior_rules, settings.training_rule]
    return list(
        dict.fromkeys([*compared_columns(settings.comparisons), *(c for r in rules for c in r)])
    )


def build_profiles(people: DataFrame, settings: MatchSettings) -> DataFrame:
    return fold_profiles(people, profile_columns(settings), settings.source, settings.id_col)


def fit_model(profiles: DataFrame, people: DataFrame, settings: MatchSettings) -> Model:
    """Prior from the deterministic rules, u by request, m from the training block."""
    found = estimate_prior(profiles, settings.prior_rules, settings.recall, settings.source)
    model = Model.start(settings.comparisons, found.first()["prior"])
    if settings.learn_u:
        model = train_u(
            people, model, settings.u_records, settings.u_partners, settings.source, settings.id_col
        )
    return train_m(
        profiles,
        model,
        settings.training_rule,
        settings.source,
        settings.max_iterations,
        settings.tolerance,
        settings.cell_rows,
    )


def compare_candidates(profiles: DataFrame, settings: MatchSettings) -> DataFrame:
    """Blocked profile pairs with their levels, which are taken where the pairs are formed."""
    pairs_of = partial(compared_block, comparisons=settings.comparisons)
    pairs = candidate_pairs(
        profiles, settings.rules, settings.source, settings.cell_rows, pairs_of
    )
    keep = ["profile_id_l", "profile_id_r", "match_key", "n_pairs"]
    for c in (settings.source, *settings.equal):
        keep += [f"{c}_l", f"{c}_r"]
    return compare(pairs, settings.comparisons, list(dict.fromkeys(keep)))


def entity_labels(
    people: DataFrame, profiles: DataFrame, model: Model, settings: MatchSettings
) -> DataFrame:
    """Every record id with its source and its ``component``, the smallest id of its entity.

    With an ordinary model the work is done on groups over all sources. If the model needs every
    comparison of every pair, profiles are compared pair by pair.
    """
    s = settings
    rules = widest_rules(s.rules)
    alike = next((c for c in model.comparisons if c.gamma == s.alike), None)
    if alike is None:
        raise ValueError(f"no comparison is named {s.alike}, which decides strict matches")
    link_at = max(s.predict_at, s.match_at)  # a match is a prediction first
    if len(rules) == 1 and alike.thresholds and can_enumerate(model):
        block = list(dict.fromkeys([*rules[0], *s.equal]))
        idle = idle_comparisons(model, link_at, block, alike)
        kept = tuple(c for c in model.comparisons if c not in idle)
        small = replace(model, comparisons=kept)
        if alike.column not in block and twins_match(small, link_at, block, alike):
            columns = list(dict.fromkeys([*block, alike.column, *compared_columns(kept)]))
            groups = materialize(
                fold_groups(profiles, columns, [*block, alike.column], s.source, "profile_id"),
                "groups",
            )
            edges = group_edges(groups, block, small, link_at, alike, s.cell_rows)
            components = connected_components(edges)
            return spread_groups(people, groups, components, columns, s.id_col, [s.source])
    matches = strict_matches(
        predict(compare_candidates(profiles, s), model, s.predict_at), s.match_at, s.equal, s.alike
    )
    components = connected_components(matches, "profile_id_l", "profile_id_r")
    columns = list(dict.fromkeys([s.source, *profile_columns(s)]))
    narrow = people.select(s.id_col, *columns)
    return spread_components(narrow, profiles, components, columns, s.id_col).select(
        s.id_col, s.source, "component"
    )


class MatchResult:
    """What a match run can give. Everything is built when it is first asked for.

    The golden ids do not need all candidate pairs, so pairs are only formed for ``predictions``,
    ``matches`` and ``metrics``.
    """

    def __init__(
        self,
        records: DataFrame,
        people: DataFrame,
        profiles: DataFrame,
        model: Model,
        run_at: datetime,
        settings: MatchSettings,
    ) -> None:
        self.records = records
        self.people = people
        self.profiles = profiles
        self.model = model
        self.run_at = run_at
        self.settings = settings

    @cached_property
    def predictions(self) -> DataFrame:
        """Scored profile pairs above the prediction threshold."""
        gammas = compare_candidates(self.profiles, self.settings)
        return stamp_run(predict(gammas, self.model, self.settings.predict_at), self.run_at)

    @cached_property
    def matches(self) -> DataFrame:
        """The predictions that pass the strict filter."""
        s = self.settings
        return strict_matches(self.predictions, s.match_at, s.equal, s.alike)

    @cached_property
    def _golden(self) -> tuple[DataFrame, dict[str, int]]:
        s = self.settings
        labels = entity_labels(self.people, self.profiles, self.model, s)
        return golden_table(labels, s.id_col, s.source)

    @property
    def golden_ids(self) -> DataFrame:
        """Golden id, record id, source and the entity's number of sources; written once, as every
        report starts from it."""
        return self._golden[0]

    @cached_property
    def golden(self) -> DataFrame:
        """Every record with its golden id."""
        s = self.settings
        ids = self.golden_ids.select("golden_id", s.id_col)
        return stamp_run(attach_records(ids, self.records, s.id_col), self.run_at)

    @cached_property
    def multi_source(self) -> DataFrame:
        """Members of the entities that occur in more than one source.

        The records of the members found come last.
        """
        s = self.settings
        members = self.golden_ids.where("county_count > 1").drop(s.source)
        found = members.join(self.records, s.id_col, "left").select(
            "golden_id",
            "county_count",
            s.id_col,
            *[c for c in self.records.columns if c != s.id_col],
        )
        return stamp_run(found, self.run_at)

    @cached_property
    def metrics(self) -> DataFrame:
        """Counts seen when the golden ids were written, and one pass over the predictions."""
        s = self.settings
        strict = is_strict(s.match_at, s.equal, s.alike)
        return run_metrics(self._golden[1], self.predictions, strict)


def match_records(
    records: DataFrame, run_at: datetime, settings: MatchSettings = MatchSettings()
) -> MatchResult:
    """Link ``records`` across sources: fold them into profiles and train the model.

    The profiles are written once to the scratch folder; they feed the prior, the training, the
    entities and the predictions. Record ids must be unique, since reports join records by them.
    """
    ids = records.groupBy(settings.id_col).count().where("count > 1")
    if repeated := ids.take(1):
        raise ValueError(f"{settings.id_col} {repeated[0][0]!r} is not unique; number the records first")
    people = normalise_people(records, settings.empty_as_null)
    profiles = materialize(build_profiles(people, settings), "profiles")
    model = fit_model(profiles, people, settings)
    return MatchResult(records, people, profiles, model, run_at, settings)
