"""The batch composition: from typed events and match records to all results.

Each stage is a function of the stages before it. ``Gold`` builds a stage when
it is first asked for and writes the two compact tables that several later
stages read (player counts, participations), so the events are scanned once
however many results are asked for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pitchline.operators import answers, chemistry, lineup, prediction, ratings, stats, summary
from pitchline.operators.facts import event_facts
from pitchline.settings import CHUNK_DAYS, materialize
from pitchline.sources import lines as line_source
from pitchline.sources import requests as request_source
from pitchline.sources import warehouse
from pitchline.sources.catalog import Catalog


class Gold:
    def __init__(
        self,
        counts: DataFrame,
        matches: DataFrame,
        minutes_mode: str = lineup.ON_FIELD,
        chunk_days: int = CHUNK_DAYS,
        dead_letters: DataFrame | None = None,
        only: DataFrame | None = None,
    ):
        self.counts = counts
        self.matches = matches
        self.minutes_mode = minutes_mode
        self.chunk_days = chunk_days
        self.dead_letters = dead_letters
        self.only = only

    def among(self, players: DataFrame) -> "Gold":
        """The same for the given players (``player_id``) alone.

        A player's ratings follow from the player's own matches, and an edge from those of
        its two players, so the participations are cut before anything is rated or paired.
        """
        asked = materialize(players.select("player_id").where("player_id IS NOT NULL").distinct(), "asked_players")
        return Gold(self.counts, self.matches, self.minutes_mode, self.chunk_days, self.dead_letters, asked)

    @classmethod
    def from_lines(cls, lines: DataFrame, **options) -> "Gold":
        """From record lines of both kinds, interleaved in any order; lines that are neither become ``dead_letters``.

        The text is read once, into one part per kind; what follows reads its part.
        """
        kinds = line_source.split_by_kind(lines)
        facts = event_facts(line_source.parse_events(kinds.events))
        records = line_source.first_match_records(line_source.parse_matches(kinds.matches))
        return cls(
            materialize(stats.count_by_player(facts), "player_counts"),
            materialize(records, "match_records"),
            dead_letters=kinds.dead_letters,
            **options,
        )

    @classmethod
    def from_warehouse(cls, spark: SparkSession, sf_dir: str, **options) -> "Gold":
        counted = materialize(warehouse.counts(warehouse.table(spark, sf_dir, "events")), "player_counts")
        return cls(counted, warehouse.matches(counted), **options)

    @cached_property
    def player_match_stats(self) -> DataFrame:
        return stats.with_ratios(stats.assigned(self.counts))

    @cached_property
    def appearances(self) -> DataFrame:
        return lineup.appearances(self.matches, self.minutes_mode)

    @cached_property
    def match_counts(self) -> DataFrame:
        return lineup.match_counts(self.appearances)

    @cached_property
    def participations(self) -> DataFrame:
        apps = self.appearances
        if self.only is not None:
            apps = apps.join(self.only, "player_id", "left_semi")
        return materialize(ratings.participations(self.player_match_stats, apps), "participations")

    @cached_property
    def match_ratings(self) -> DataFrame:
        """Stored, because the split scan reads its input several times."""
        return materialize(ratings.match_ratings(self.participations, chunk_days=self.chunk_days), "match_ratings")

    @cached_property
    def rating_history(self) -> DataFrame:
        """Stored, because latest ratings and both sides of the pairs read it."""
        return materialize(ratings.player_ratings(self.match_ratings, chunk_days=self.chunk_days), "rating_history")

    @cached_property
    def latest_ratings(self) -> DataFrame:
        return ratings.latest_ratings(self.rating_history)

    @cached_property
    def player_profiles(self) -> DataFrame:
        return stats.player_profiles(self.player_match_stats)

    @cached_property
    def pair_updates(self) -> DataFrame:
        return chemistry.pair_updates(self.rating_history)

    @cached_property
    def chemistry(self) -> DataFrame:
        return chemistry.chemistry(self.pair_updates, chunk_days=self.chunk_days)

    @cached_property
    def match_summaries(self) -> DataFrame:
        return summary.match_summaries(self.matches)

    def answer(self, asked: DataFrame, players: DataFrame, teams: DataFrame) -> dict[str, DataFrame]:
        """The answers to a mixed set of requests, one table per kind; edges are those of the requested players."""
        members = prediction.lineups(request_source.routed(asked, "predict"), players)
        return answers.answer_all(
            asked, players, teams,
            ratings=self.latest_ratings, chemistry=self.among(members).chemistry,
            profiles=self.player_profiles, summaries=self.match_summaries,
        )

    def publish(self, catalog: Catalog, version: int, fmt: str = "parquet") -> None:
        """Store every result as a snapshot, under the names the streaming pipeline uses."""
        results = {
            "player_profile": self.player_profiles,
            "player_rating": self.latest_ratings,
            "match_rating": self.rating_history,
            "match_summary": self.match_summaries,
            "match_count": self.match_counts,
            "chemistry": self.chemistry,
        }
        catalog.publish(results, version, fmt)
