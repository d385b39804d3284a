"""Contract stamping, merging and the fail-closed checks of replay documents.

A document is one row, so every check is an expression over that row: the gate adds
no shuffle to the join that brought metadata and replay together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.functions import coords as C
from matchloom.functions import text as X
from matchloom.functions import times as T
from matchloom.functions.expr import differs, is_true, let, once, present, reasons, same_set
from matchloom.operators.replays import side_of

SIDES = ("team", "opponent")
TIERS = ("schema", "mapping", "mode", "version", "terminal", "king_level", "deck", "events")


@dataclass(frozen=True)
class Contract:
    """Allow-lists a battle is checked against. The reader bounds their size."""

    version: int
    game_version: str
    sha256: str
    cards: tuple[str, ...]
    towers: tuple[str, ...]
    ability_sources: tuple[str, ...]
    modes: dict[int, int] = field(default_factory=dict)
    king_full_hp: int = V.KING_FULL_HP

    def execution_mode(self, mode: Column) -> Column:
        pairs = [F.lit(x) for kv in sorted(self.modes.items()) for x in kv]
        return F.try_element_at(F.create_map(*pairs), mode)


def _strings(values) -> Column:
    """A constant array, folded from one literal: allow-lists run to hundreds of entries."""
    values = list(values)
    return F.split(F.lit("\n".join(values)), "\n") if values else F.array().cast("array<string>")


def _player(rounds: Column, side: str) -> Column:
    first = F.when(F.size(rounds) == 1, F.get(rounds, F.lit(0)))
    return F.when(F.size(first[side]) == 1, F.get(first[side], F.lit(0)))


def king_evidence(contract: Contract, mode: Column, rounds: Column, hp: Column, side: str) -> Column:
    """How the king tower's level is proven on one side, null when it is not."""
    allowed = is_true(mode.isin(*contract.modes))
    by_tower = F.lit(contract.version >= 3) & (_player(rounds, side)["tower_troop_level"] == V.KING_LEVEL)
    by_hp = hp[side]["king"] == contract.king_full_hp
    return F.when(allowed & is_true(by_tower), F.lit(V.KING_FROM_TOWER_LEVEL)).when(
        allowed & is_true(by_hp), F.lit(V.KING_FROM_FULL_HP))


def in_contract(contract: Contract) -> Column:
    """Mode, king evidence, every card and tower of a battle are in the contract."""
    rounds, mode, hp = F.col("rounds"), F.col("numeric_game_mode_id"), F.col("final_tower_hp")
    players = F.flatten(F.transform(rounds, lambda r: F.concat(r["team"], r["opponent"])))
    known = F.forall(
        players,
        lambda p: (F.size(F.array_except(F.transform(p["full_deck"], lambda c: F.lower(F.btrim(c))), _strings(contract.cards))) == 0)
        & is_true(F.lower(p["tower_troop"]).isin(*contract.towers)),
    )
    evidence = [king_evidence(contract, mode, rounds, hp, s).isNotNull() for s in SIDES]
    return is_true(F.col("authoritative_complete") & mode.isin(*contract.modes) & evidence[0] & evidence[1] & known)


def eligible(
    contract: Contract | None = None, low: int | None = None, high: int | None = None,
    now: int | None = None,
) -> Column:
    """Battles worth a replay: normal, in contract, in the window, not from the future.
    Cohort membership is a semi-join (see ``cohort.with_member_side``)."""
    stamp = T.epoch_seconds(F.col("timestamp"))
    test = F.col("normal_1v1") & T.in_window(stamp, low, high)
    if contract is not None:
        test = test & in_contract(contract)
    if now is not None:
        test = test & is_true(stamp <= now + V.FUTURE_TOLERANCE_SECONDS)
    return is_true(test)


def early_decision(contract: Contract) -> Column:
    """Tier and reason known from metadata alone, before a replay is joined; else null."""
    mode = F.col("numeric_game_mode_id")
    missing = present(F.array(*[
        F.when(king_evidence(contract, mode, F.col("rounds"), F.col("final_tower_hp"), s).isNull(),
               F.lit(f"{s}_king_tower_level_exact_evidence_missing")) for s in SIDES
    ]))
    return (
        F.when(~is_true(F.col("authoritative_complete")),
               F.struct(F.lit("dependency_unresolved").alias("tier"), F.lit("metadata dependency exhausted").alias("reason")))
        .when(~is_true(mode.isin(*contract.modes)),
              F.struct(F.lit("mode").alias("tier"), F.lit("numeric_game_mode_not_allowed").alias("reason")))
        .when(F.size(missing) > 0,
              F.struct(F.lit("king_level").alias("tier"), F.array_join(missing, ";").alias("reason")))
    )


# -- merge ----------------------------------------------------------------------

_MERGED = (
    "battle_type", "game_mode", "numeric_game_mode_id", "numeric_game_mode_provenance", "battle_index",
    "battle_index_provenance", "matchup_players", "draft", "timestamp", "version_timestamp",
    "version_timestamp_provenance", "battle_time_utc", "battle_time_utc_provenance", "team_tags",
    "opponent_tags", "team_crowns", "opponent_crowns", "rounds", "final_tower_hp", "normal_1v1",
    "deck_crosscheck_complete",
)


def merge(replays: DataFrame, metadata: DataFrame) -> DataFrame:
    """Replay documents with the metadata of their battle, where there is any.

    One equi-join on the battle tag; decks give each play its form, and each side its
    unplayed and unknown cards.
    """
    described = metadata.withColumn("draft", is_true(F.col("draft"))).select(
        "battle_tag", *_MERGED,
        F.struct(
            is_true(F.col("complete")).alias("complete"),
            is_true(F.col("authoritative_complete")).alias("authoritative_complete"),
            "source", "source_list_url", "schema_version",
        ).alias("deck_metadata"),
    )
    unknown = F.struct(
        F.lit(False).alias("complete"), F.lit(False).alias("authoritative_complete"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("source_list_url"),
        F.lit(1).alias("schema_version"),
    )
    joined = replays.join(described, "battle_tag", "left").withColumns({
        "deck_metadata": F.coalesce("deck_metadata", unknown),
        "schema_version": F.lit(V.REPLAY_SCHEMA_VERSION),
        "team_deck": _player(F.col("rounds"), "team")["full_deck"],
        "opponent_deck": _player(F.col("rounds"), "opponent")["full_deck"],
    })

    def by_base(deck: str) -> Column:
        """Slug of each base; of cards sharing a base the last."""
        return let(
            F.transform(F.col(deck), lambda c: F.struct(X.base_slug(c).alias("b"), c.alias("c"))),
            lambda pairs: let(F.array_distinct(F.transform(pairs, lambda p: p["b"])), lambda own: F.when(
                F.size(own) == F.size(pairs), F.map_from_entries(pairs)).otherwise(F.map_from_entries(F.transform(
                    own, lambda b: F.struct(b.alias("b"), F.element_at(F.filter(pairs, lambda p: p["b"] == b), -1)["c"].alias("c")))))),
        )

    def with_forms(plays: Column) -> Column:
        forms = F.struct(by_base("team_deck").alias("team"), by_base("opponent_deck").alias("opponent"))

        def form(play: Column, f: Column) -> Column:
            own = F.when(play["side"] == "team", f["team"]).otherwise(f["opponent"])
            return let(X.base_slug(play["card"]), lambda base: play.withField("card_base", base).withField(
                "card_form", F.try_element_at(own, base)))

        return let(forms, lambda f: F.transform(plays, lambda p: form(p, f)))

    def bases(cards: Column) -> Column:
        return F.array_distinct(F.transform(cards, X.base_slug))

    def validation(side: str) -> tuple[Column, Column]:
        deck, played = bases(F.col(f"{side}_deck")), bases(F.map_keys(F.col("card_counts")[side]))
        return (
            F.array_sort(F.array_except(deck, played)).alias(f"{side}_unplayed_cards"),
            F.array_sort(F.array_except(played, deck)).alias(f"{side}_played_unknown"),
        )

    both = F.col("team_deck").isNotNull() & F.col("opponent_deck").isNotNull()
    return once(joined, {
        "card_plays": with_forms(F.col("card_plays")),
        "deck_validation": F.when(both, F.struct(*validation("team"), *validation("opponent"))),
    })


def stamp(documents: DataFrame, contract: Contract) -> DataFrame:
    """Execution mode and king levels as the contract gives them; earlier values go."""
    mode = F.col("numeric_game_mode_id")
    allowed = is_true(mode.isin(*contract.modes))
    evidence = {s: king_evidence(contract, mode, F.col("rounds"), F.col("final_tower_hp"), s) for s in SIDES}

    def stamped(players: Column, proof: Column) -> Column:
        return F.transform(players, lambda p: p.withField(
            "king_tower_level", F.when(proof.isNotNull(), F.lit(V.KING_LEVEL))
        ).withField("king_tower_level_provenance", proof))

    staged = documents.withColumns({f"_{s}_proof": evidence[s] for s in SIDES})
    return staged.withColumns({
        "execution_game_mode_id": F.when(allowed, contract.execution_mode(mode)),
        "execution_game_mode_provenance": F.when(allowed, F.lit(V.EXECUTION_MODE_FROM_CONTRACT)),
        "rounds": F.transform("rounds", lambda r: F.struct(*[
            stamped(r[s], F.col(f"_{s}_proof")).alias(s) for s in SIDES])),
    }).drop(*[f"_{s}_proof" for s in SIDES])


# -- ordinary validation ------------------------------------------------------------

#: What the ordinary checks read of a merged document, besides its tag.
CHECKED = ("replay_tag", "card_plays", "ability_plays", "duration_seconds", "schema_version", "orientation_contract", "elixir_stats")


def _count_of(side: str, title: str) -> Column:
    return F.try_element_at(F.col("elixir_stats")[side], F.lit(title))["count"]


def _event_error(e: Column, ability: bool) -> Column:
    """First fault of one event in checking order."""
    raw_bad = e["data_i"].isNull() | ~e["data_i"].isin(0, 1) | e["x_raw"].isNull() | e["y_raw"].isNull()
    bounds = C.orientation_error(e["x_raw"], e["y_raw"], e["data_i"])
    kind = "ability" if ability else "card play"
    spatial = e["coordinate_status"] == "resolved"
    checked = spatial if ability else F.lit(True)
    error = F.when(e["time_raw"].isNull() | (e["time_raw"] < 0), F.lit(f"invalid {kind} tick"))
    if ability:
        error = error.when(
            (e["coordinate_status"] == "not_applicable") & (e["x_raw"].isNotNull() | e["y_raw"].isNotNull()),
            F.lit("non-spatial ability carries partial raw coordinate"),
        ).when(~is_true(e["coordinate_status"].isin("resolved", "not_applicable")), F.lit("invalid ability coordinate_status"))
    else:
        error = error.when(raw_bad, F.lit("invalid card play raw coordinate provenance"))
    return (
        error.when(checked & bounds.isNotNull(), F.concat(F.lit(f"invalid {kind} raw coordinate: "), bounds))
        .when(checked & differs(e["coordinate_provenance"], F.lit(V.ORIENTATION_ID)), F.lit(f"{kind} coordinate_provenance mismatch"))
        .when(checked & differs(e["coordinate_transform"], C.transform_name(e["data_i"])), F.lit(f"{kind} coordinate_transform mismatch"))
        .when(checked & (differs(e["x"], C.oriented_x(e["x_raw"], e["data_i"])) | differs(e["y"], C.oriented_y(e["y_raw"], e["data_i"]))),
              F.lit(f"{kind} native coordinate mismatch"))
    )


def first_error(expected_tag: Column) -> Column:
    """The first thing wrong with a merged document, null when nothing is."""
    plays, abilities = F.col("card_plays"), F.col("ability_plays")
    tag = F.coalesce(F.col("replay_tag"), F.lit(""))
    error = (
        F.when(tag == "", F.lit("replay battle_tag missing"))
        .when((expected_tag != "") & (tag != expected_tag),
              F.concat(F.lit("replay battle_tag mismatch: "), tag, F.lit(" != "), expected_tag))
        .when(plays.isNull() | (F.size(plays) == 0), F.lit("replay has no card plays"))
        .when(F.col("duration_seconds").isNull() | ~F.col("duration_seconds").between(1, V.MAX_DURATION_SECONDS),
              F.concat(F.lit("invalid replay duration: "), F.coalesce(F.col("duration_seconds").cast("string"), F.lit("None"))))
        .when(abilities.isNull(), F.lit("ability_plays missing"))
        .when(differs(F.col("schema_version"), F.lit(V.REPLAY_SCHEMA_VERSION)),
              F.concat(F.lit("unexpected replay schema_version: "), F.coalesce(F.col("schema_version").cast("string"), F.lit("None"))))
        .when(F.col("orientation_contract").isNull(), F.lit("coordinate_provenance missing"))
        .when(differs(F.col("orientation_contract"), C.orientation_contract()), F.lit("coordinate_provenance contract mismatch"))
    )
    for side in SIDES:
        marked, table = F.size(side_of(plays, side)), _count_of(side, "Total")
        used, listed = F.size(side_of(abilities, side)), F.coalesce(_count_of(side, "Ability"), F.lit(0))
        error = error.when(
            differs(table, marked),
            F.concat(F.lit(f"card play count mismatch for {side}: markers="), marked,
                     F.lit(", table="), F.coalesce(table.cast("string"), F.lit("None"))),
        ).when(
            listed != used,
            F.concat(F.lit(f"ability count mismatch for {side}: markers="), used, F.lit(", table="), listed))
    in_plays = F.get(present(F.transform(plays, lambda e: _event_error(e, False))), F.lit(0))
    in_abilities = F.get(present(F.transform(abilities, lambda e: _event_error(e, True))), F.lit(0))
    return error.otherwise(F.coalesce(in_plays, in_abilities))


def ordinary_outcome(error: Column, strict: bool) -> Column:
    """What follows from a first error: no plays is filtered, the rest tried again or rejected."""
    return (
        F.when(error.isNull(), F.lit("accepted"))
        .when(error == "replay has no card plays", F.lit("filtered"))
        .otherwise(F.lit("rejected" if strict else "retry"))
    )


# -- strict gate --------------------------------------------------------------------


def _schema_tier() -> Column:
    # One reason only: each check presumes the one before.
    return present(F.array(
        F.when(differs(F.col("schema_version"), F.lit(V.REPLAY_SCHEMA_VERSION)), F.lit("schema_version_not_authoritative"))
        .when(differs(F.col("orientation_contract"), C.orientation_contract()), F.lit("coordinate_contract_missing_or_mismatched"))
        .when(F.coalesce(F.btrim("battle_tag"), F.lit("")) == "", F.lit("battle_tag_missing"))
    ))


def _mode_tier(contract: Contract) -> Column:
    rounds, mode = F.col("rounds"), F.col("numeric_game_mode_id")
    first = F.get(rounds, F.lit(0))
    single = F.coalesce(F.size(rounds), F.lit(0)) == 1
    has_mode = is_true(mode >= 1)
    allowed = is_true(mode.isin(*contract.modes))
    return reasons(
        (differs(F.col("draft"), F.lit(False)), "draft_or_unknown"),
        (differs(F.col("matchup_players"), F.lit("1v1")), "matchup_players_not_1v1"),
        (~single, "not_single_round"),
        (single & ((F.size(first["team"]) != 1) | (F.size(first["opponent"]) != 1)), "not_one_player_per_side"),
        (F.col("battle_type") == V.DUEL_BATTLE_TYPE, "river_race_duel"),
        (~has_mode, "numeric_game_mode_id_missing"),
        (has_mode & ~allowed, "numeric_game_mode_not_allowed"),
        (allowed & differs(F.col("execution_game_mode_id"), contract.execution_mode(mode)), "native_execution_game_mode_mismatch"),
        (allowed & differs(F.col("execution_game_mode_provenance"), F.lit(V.EXECUTION_MODE_FROM_CONTRACT)),
         "native_execution_game_mode_provenance_invalid"),
        (differs(F.col("numeric_game_mode_provenance"), F.lit(V.MODE_FROM_MATCHUP)), "numeric_game_mode_provenance_missing"),
        (~is_true(F.col("battle_index") >= 1), "battle_index_missing"),
        (differs(F.col("battle_index_provenance"), F.lit(V.INDEX_FROM_BOTH)), "battle_index_provenance_missing"),
    )


def _version_tier(min_timestamp: int | None) -> Column:
    stamp_ = F.col("version_timestamp")
    exact = is_true(stamp_ >= 1)
    early = exact & (stamp_ < min_timestamp) if min_timestamp is not None else F.lit(False)
    return reasons(
        (~exact, "exact_version_timestamp_missing"),
        (early, "before_native_version_window"),
        (differs(F.col("version_timestamp_provenance"), F.lit(V.TIME_FROM_LIST)), "version_timestamp_provenance_missing"),
        (~is_true(F.col("battle_time_utc").endswith("Z")), "battle_time_utc_missing"),
        (~is_true(F.col("battle_time_utc_provenance").isin(V.UTC_FROM_POPUP, V.UTC_FROM_TIMESTAMP)), "battle_time_utc_provenance_missing"),
    )


def _terminal_tier() -> Column:
    hp = F.col("final_tower_hp")
    known = is_true(hp["provenance"] == V.HP_FROM_POPUP)
    tests = [(~known, "final_tower_hp_missing")]
    for s in SIDES:
        v = [hp[s][n] for n in ("king", "princess0", "princess1", "total")]
        valid = is_true((v[0] >= 0) & (v[1] >= 0) & (v[2] >= 0) & (v[3] >= 0))
        tests += [
            (known & hp[s].isNull(), f"{s}_tower_hp_missing"),
            (known & hp[s].isNotNull() & ~valid, f"{s}_tower_hp_invalid"),
            (known & valid & (v[3] != v[0] + v[1] + v[2]), f"{s}_tower_hp_total_mismatch"),
        ]
    tests += [(~is_true(F.col(f"{s}_crowns").between(0, V.MAX_CROWNS)), f"{s}_crowns_invalid") for s in SIDES]
    return reasons(*tests)


def _king_tier(contract: Contract) -> Column:
    tests = []
    for s in SIDES:
        player = _player(F.col("rounds"), s)
        proof = king_evidence(contract, F.col("numeric_game_mode_id"), F.col("rounds"), F.col("final_tower_hp"), s)
        one = player.isNotNull()
        tests += [
            (~one, f"{s}_king_tower_player_missing"),
            (one & differs(player["king_tower_level"], F.lit(V.KING_LEVEL)), f"{s}_king_tower_level_missing"),
            (one & proof.isNull(), f"{s}_king_tower_level_exact_evidence_missing"),
            (one & proof.isNotNull() & differs(player["king_tower_level_provenance"], proof), f"{s}_king_tower_level_provenance_invalid"),
        ]
    return reasons(*tests)


def _slugs(side: str) -> Column:
    return F.transform(F.col(f"{side}_deck"), lambda c: F.lower(F.btrim(c)))


def _deck_tier(contract: Contract) -> Column:
    def side_reasons(s: str) -> Column:
        deck = F.col(f"{s}_deck")

        def checks(found: Column) -> Column:
            return let(F.transform(found["slugs"], X.base_slug), lambda bases: faults(found["slugs"], bases, found["player"]))

        def faults(slugs: Column, bases: Column, player: Column) -> Column:
            # Tested one by one against a constant set: a difference of arrays would hash the whole list for every row.
            unsupported = F.array_sort(F.filter(F.array_distinct(slugs), lambda c: ~is_true(c.isin(*contract.cards))))
            one = player.isNotNull()
            levels, cards = player["card_levels"], player["deck_cards"]
            levels_known = is_true(same_set(F.map_keys(levels), slugs))
            cards_known = is_true(F.size(cards) == V.DECK_SIZE)
            slot_faults = F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.lit(V.DECK_SIZE - 1)),
                    lambda i: let(
                        F.struct(F.get(cards, i).alias("c"), F.get(slugs, i).alias("s")),
                        lambda p: differs(p["c"]["slot"], i) | differs(p["c"]["slug"], p["s"])
                        | differs(p["c"]["base_slug"], F.get(bases, i)) | differs(p["c"]["form"], X.card_form(p["s"]))
                        | ~is_true(p["c"]["level"] >= 1),
                    ),
                ),
                lambda i: F.concat(F.lit(f"{s}_deck_card_"), i, F.lit("_invalid")),
            )
            before = reasons(
                (F.exists(slugs, lambda c: (c == "") | (c == V.INVALID_CARD)), f"{s}_deck_invalid_slug"),
                ((F.size(F.array_distinct(slugs)) != V.DECK_SIZE) | (F.size(F.array_distinct(bases)) != V.DECK_SIZE),
                 f"{s}_deck_not_unique_cycle"),
                (F.size(unsupported) > 0, F.concat(F.lit(f"{s}_native_card_mapping_missing:"), F.array_join(unsupported, ","))),
                (one & differs(player["full_deck"], deck), f"{s}_round_deck_mismatch"),
                (one & ~levels_known, f"{s}_card_levels_missing"),
                (one & levels_known & F.exists(F.map_values(levels), lambda v: ~is_true(v >= 1)), f"{s}_card_level_invalid"),
                (one & ~cards_known, f"{s}_deck_cards_missing"),
            )
            after = reasons(
                (one & (F.coalesce(player["tower_troop"], F.lit("")) == ""), f"{s}_tower_troop_missing"),
                (one & (player["tower_troop"] != "") & ~F.lower(player["tower_troop"]).isin(*contract.towers),
                 f"{s}_native_tower_troop_mapping_missing"),
                (one & ~is_true(player["tower_troop_level"] >= 1), f"{s}_tower_troop_level_missing"),
            )
            slots = F.when(one & cards_known, slot_faults).otherwise(_strings([]))
            return F.concat(before, slots, after)

        eight = is_true(F.size(deck) == V.DECK_SIZE)
        return F.when(~eight, _strings([f"{s}_deck_not_8"])).otherwise(let(
            F.struct(_slugs(s).alias("slugs"), _player(F.col("rounds"), s).alias("player")), checks))

    return F.array_distinct(F.concat(side_reasons("team"), side_reasons("opponent")))


def _events_tier(contract: Contract) -> Column:
    plays, abilities = F.col("card_plays"), F.col("ability_plays")
    early = (
        F.when(plays.isNull() | (F.size(plays) == 0), F.lit("card_plays_missing"))
        .when(abilities.isNull(), F.lit("ability_plays_missing"))
        .when(~is_true(F.col("duration_seconds").between(1, V.MAX_DURATION_SECONDS)), F.lit("duration_invalid"))
    )
    known_side = lambda e: is_true(e["side"].isin(*SIDES))

    def decks() -> Column:
        def side(s: str) -> Column:
            return F.transform(_slugs(s), lambda c: F.struct(X.base_slug(c).alias("b"), c.alias("c")))

        return F.struct(side("team").alias("team"), side("opponent").alias("opponent"))

    def play_faults(e: Column, d: Column) -> Column:
        deck = F.when(e["side"] == "team", d["team"]).otherwise(d["opponent"])
        own = let(
            X.base_slug(F.coalesce(e["card"], F.lit(""))),
            lambda base: F.try_element_at(F.filter(deck, lambda p: p["b"] == base), F.lit(-1))["c"])
        unplaced = C.orientation_error(e["x_raw"], e["y_raw"], e["data_i"])
        wrong = (
            differs(e["coordinate_provenance"], F.lit(V.ORIENTATION_ID))
            | differs(e["coordinate_transform"], C.transform_name(e["data_i"]))
            | differs(e["x"], C.oriented_x(e["x_raw"], e["data_i"])) | differs(e["y"], C.oriented_y(e["y_raw"], e["data_i"]))
        )
        return F.when(~known_side(e), _strings(["deployment_side_invalid"])).otherwise(let(own, lambda card: reasons(
            (~is_true(e["time_raw"] >= 0), "deployment_exact_tick_missing"),
            (~is_true(e["marker_index"] >= 0), "deployment_marker_index_missing"),
            (card.isNull(), F.concat(e["side"], F.lit("_played_card_not_in_deck"))),
            (card.isNotNull() & differs(e["card_form"], card), F.concat(e["side"], F.lit("_played_card_form_unmapped"))),
            (unplaced.isNull() & wrong, "deployment_coordinate_mismatch"),
            (unplaced.isNotNull(), "deployment_raw_coordinate_invalid"),
        )))

    def ability_faults(e: Column) -> Column:
        return reasons(
            (~known_side(e), "ability_side_invalid"),
            (~is_true(e["time_raw"] >= 0), "ability_exact_tick_missing"),
            (~is_true(e["marker_index"] >= 0), "ability_marker_index_missing"),
            (~is_true(e["coordinate_status"].isin("not_applicable", "resolved")), "ability_coordinate_status_missing"),
        )

    def side_faults(s: str) -> Column:
        played = F.transform(side_of(plays, s), lambda e: X.base_slug(e["card"]))
        cycle = let(
            F.transform(_slugs(s), X.base_slug),
            lambda own: is_true(same_set(F.array_intersect(F.array_distinct(played), own), own)))
        listed = F.coalesce(_count_of(s, "Ability"), F.lit(0))
        return reasons(
            (~cycle, f"{s}_incomplete_observed_8_card_cycle"),
            (differs(_count_of(s, "Total"), F.size(side_of(plays, s))), f"{s}_deployment_count_mismatch"),
            (listed != F.size(side_of(abilities, s)), f"{s}_ability_count_mismatch"),
            ((listed != 0) & (F.size(F.array_intersect(_slugs(s), _strings(contract.ability_sources))) == 0),
             f"{s}_native_ability_source_mapping_missing"),
        )

    def command(e: Column) -> Column:
        return F.struct(e["marker_index"].alias("i"), F.coalesce(e["time_raw"], F.lit(-1)).alias("t"),
                        e["side"].alias("s"), e["time_raw"].alias("raw"))

    commands = F.concat(
        F.transform(F.filter(plays, known_side), command), F.transform(abilities, command))
    all_commands = F.concat(F.transform(plays, command), F.transform(abilities, command))

    def collision(s: str) -> Column:
        ticks = F.transform(
            F.filter(all_commands, lambda c: (c["s"] == s) & is_true(c["raw"] >= 0)), lambda c: c["raw"])
        return let(ticks, lambda t: F.size(F.array_distinct(t)) < F.size(t))

    def order_faults(indexed: Column) -> Column:
        return let(F.transform(indexed, lambda c: c["i"]), lambda indexes: faults_of(indexed, indexes))

    def faults_of(indexed: Column, indexes: Column) -> Column:
        n = F.size(indexes)
        duplicate = F.size(F.array_distinct(indexes)) < n
        gap = (n > 0) & (F.array_sort(indexes) != F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i - 1))
        unordered = F.exists(indexed, lambda c: c["t"] < 0) | let(
            F.transform(indexed, lambda c: c["t"]),
            lambda ticks: F.exists(
                F.transform(ticks, lambda t, i: is_true(t > F.get(ticks, i + 1))), lambda x: x),
        )
        return reasons(
            (duplicate, "marker_index_duplicate"),
            (~duplicate & gap, "marker_index_not_contiguous"),
            (unordered, "marker_tick_order_invalid"),
        )

    indexed = F.array_sort(F.filter(commands, lambda c: is_true(c["i"] >= 0)))
    detail = F.array_distinct(F.concat(
        let(decks(), lambda d: F.array_distinct(F.flatten(F.transform(plays, lambda e: play_faults(e, d))))),
        F.flatten(F.transform(abilities, ability_faults)),
        side_faults("team"), side_faults("opponent"),
        reasons((collision("team"), "team_multiple_commands_same_tick"),
                (collision("opponent"), "opponent_multiple_commands_same_tick")),
        let(indexed, order_faults),
    ))
    return F.when(early.isNotNull(), F.array(early)).otherwise(detail)


#: What the strict gate reads of a stamped document.
JUDGED = (
    "battle_tag", "schema_version", "orientation_contract", "draft", "matchup_players", "rounds", "battle_type", "numeric_game_mode_id",
    "numeric_game_mode_provenance", "execution_game_mode_id", "execution_game_mode_provenance", "battle_index", "battle_index_provenance",
    "version_timestamp", "version_timestamp_provenance", "battle_time_utc", "battle_time_utc_provenance", "final_tower_hp", "team_crowns",
    "opponent_crowns", "team_deck", "opponent_deck", "card_plays", "ability_plays", "duration_seconds", "elixir_stats")


def evaluate(documents: DataFrame, contract: Contract | None, min_timestamp: int | None = None) -> DataFrame:
    """Adds ``eligibility``: accepted, the first failing tier, and that tier's reasons."""
    if contract is None:
        tiers = {"schema": _schema_tier(), "mapping": _strings(["native_contract_missing"])}
    else:
        tiers = {
            "schema": _schema_tier(), "mode": _mode_tier(contract), "version": _version_tier(min_timestamp),
            "terminal": _terminal_tier(), "king_level": _king_tier(contract), "deck": _deck_tier(contract),
            "events": _events_tier(contract),
        }
    accepted = F.struct(F.lit(True).alias("accepted"), F.lit(V.ACCEPT_TIER).alias("tier"), _strings([]).alias("reasons"))

    def judge(left: list[tuple[str, Column]]) -> Column:
        """A later tier is looked at only where the earlier ones found nothing."""
        if not left:
            return accepted
        (tier, found), *later = left
        failed = lambda r: F.struct(F.lit(False).alias("accepted"), F.lit(tier).alias("tier"), r.alias("reasons"))
        return let(found, lambda r: F.when(F.size(r) > 0, failed(r)).otherwise(judge(later)))

    return once(documents, {"eligibility": judge(list(tiers.items()))})
