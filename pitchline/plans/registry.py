"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read the warehouse tables through the adapters of
``sources.warehouse`` and run over whole tables. Integers are returned as
BIGINT and doubles rounded to six places, on both sides of the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.functions import formulas
from pitchline.operators import answers, chemistry, lineup, prediction, ratings, stats, summary
from pitchline.operators.facts import COUNTERS, event_facts
from pitchline.plans.gold import Gold
from pitchline.settings import materialize, scratch_path
from pitchline.sources import dimensions, lines, requests, warehouse
from pitchline.sources.catalog import Catalog, write_responses
from pitchline.streaming import driver, finalise, stateful

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Added before rounding so that values ending on a half tie round alike in
# engines that differ in the last bit.
TIE_SHIFT = 1.3e-10


def tidy(df: DataFrame) -> DataFrame:
    """BIGINT for all integers, doubles rounded to six places."""
    casts = {"double": f"round({{0}} + {TIE_SHIFT!r}D, 6) AS {{0}}", "int": "bigint({0}) AS {0}"}
    return df.selectExpr(*[casts.get(kind, "{0}").format(name) for name, kind in df.dtypes])


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(fn(spark, sf_dir))

    run.__doc__, run.__name__ = fn.__doc__, fn.__name__
    QUERIES[fn.__name__] = run
    return fn


def raw_events(spark, sf_dir):
    return warehouse.table(spark, sf_dir, "events")


def facts(spark, sf_dir):
    return event_facts(warehouse.events(raw_events(spark, sf_dir)))


def players(spark, sf_dir):
    return warehouse.players(warehouse.table(spark, sf_dir, "customer"))


def teams(spark, sf_dir):
    return warehouse.teams(warehouse.table(spark, sf_dir, "nation"))


def users(counts):
    return counts.select("player_id").distinct()


def match_lines(spark, sf_dir):
    return warehouse.match_line(warehouse.matches(warehouse.counts(raw_events(spark, sf_dir))))


def feed(spark, lines_df):
    """The lines as a text source, as the engine meets them."""
    path = scratch_path(spark, "feed")
    lines_df.write.text(path)
    return lines.read_lines(spark, path)


# --- intake ---------------------------------------------------------------


def _line_id(field):
    return F.coalesce(F.get_json_object("value", f"$.{field}"), F.get_json_object("value", "$.label")).cast("bigint")


@query
def route_match_lines(spark, sf_dir):
    """Lines routed to the match branch, by the number each line carries."""
    routed = lines.route_records(warehouse.mixed_lines(raw_events(spark, sf_dir)))
    return routed.matches.select(_line_id("wyId").alias("line_no"))


@query
def route_event_lines(spark, sf_dir):
    """Lines routed to the event branch."""
    routed = lines.route_records(warehouse.mixed_lines(raw_events(spark, sf_dir)))
    return routed.events.select(_line_id("id").alias("line_no"))


@query
def dead_letter_lines(spark, sf_dir):
    """Lines that are no JSON object, as text."""
    return lines.route_records(warehouse.mixed_lines(raw_events(spark, sf_dir))).dead_letters


@query
def event_tags_exploded(spark, sf_dir):
    """Events through JSON text and back, one row per tag."""
    text = feed(spark, warehouse.event_line(warehouse.events(raw_events(spark, sf_dir))))
    return lines.read_events(text).select("event_id", "event_code", "sub_event", F.explode("tag_ids").alias("tag_id"))


@query
def event_counters(spark, sf_dir):
    """The fifteen counters of every event."""
    return facts(spark, sf_dir).select("event_id", "match_id", "player_id", *COUNTERS)


@query
def event_match_times(spark, sf_dir):
    """Match records joined to their events: wall-clock span per match."""
    text = feed(spark, _all_lines(spark, sf_dir))
    matches = lines.parse_matches(lines.route_records(text).matches)
    return lines.match_spans(lines.read_events(text), matches).selectExpr(
        "match_id", "events", "unix_micros(first_ts) AS first_micros", "unix_micros(last_ts) AS last_micros"
    )


# --- statistics -----------------------------------------------------------


@query
def player_match_counters(spark, sf_dir):
    """Summed counters per match and player, sentinel player dropped."""
    counted = stats.count_by_player(stats.assigned(facts(spark, sf_dir)))
    return counted.select("match_id", "player_id", "team_id", *COUNTERS)


@query
def player_match_ratios(spark, sf_dir):
    """The four ratios and pass totals per match and player."""
    return stats.player_match_stats(facts(spark, sf_dir)).select(
        "match_id", "player_id", *formulas.RATIOS, "pass_num", "pass_tot"
    )


@query
def career_profile(spark, sf_dir):
    """Career sums per player."""
    return stats.player_profiles(stats.player_match_stats(facts(spark, sf_dir)))


# --- line-ups -------------------------------------------------------------


@query
def match_team_ids(spark, sf_dir):
    """Team ids of every match in record order, through JSON text."""
    routed = lines.route_records(feed(spark, match_lines(spark, sf_dir)))
    return lines.match_team_ids(lines.parse_matches(routed.matches))


def _appearance_columns(apps):
    return apps.drop("kickoff", "match_day")


@query
def appearances_on_field(spark, sf_dir):
    """Playing time from the parsed match lines, real minutes."""
    routed = lines.route_records(feed(spark, match_lines(spark, sf_dir)))
    return _appearance_columns(lineup.appearances(lines.parse_matches(routed.matches)))


@query
def appearances_full_90(spark, sf_dir):
    """Playing time with 90 minutes for everybody in played matches."""
    matches = warehouse.matches(warehouse.counts(raw_events(spark, sf_dir)))
    return _appearance_columns(lineup.appearances(matches, lineup.FULL_90))


@query
def matches_played(spark, sf_dir):
    """Participations per player."""
    return Gold.from_warehouse(spark, sf_dir).match_counts


@query
def prior_match_ordinal(spark, sf_dir):
    """Earlier participations at every participation."""
    apps = Gold.from_warehouse(spark, sf_dir).appearances
    played = apps.where("participated").select("match_id", "match_day", "kickoff", "player_id")
    counted = lineup.prior_matches(materialize(played, "played"))
    return counted.select("match_id", "player_id", "prior_matches")


# --- ratings --------------------------------------------------------------


@query
def match_rating(spark, sf_dir):
    """Rating of every played match with real minutes."""
    return Gold.from_warehouse(spark, sf_dir).match_ratings.drop("kickoff", "match_day")


@query
def rating_running_mean(spark, sf_dir):
    """Events only: 90 minutes for everybody, rating = running mean."""
    measured = stats.player_match_stats(facts(spark, sf_dir))
    rated = measured.selectExpr(
        "player_id", "match_id", "CAST(NULL AS TIMESTAMP) AS kickoff", f"{warehouse.day_of('match_id')} AS match_day",
        f"{formulas.match_rating(str(formulas.FULL_MATCH_MINUTES))} AS match_rating",
    )
    history = ratings.running_mean_ratings(materialize(rated, "rated"))
    return history.select("player_id", "match_id", "match_rating", "rating", "rating_change")


@query
def rating_history(spark, sf_dir):
    """Running rating and its change after every rated match."""
    return Gold.from_warehouse(spark, sf_dir).rating_history.select(
        "player_id", "match_id", "prior_matches", "match_rating", "rating", "rating_change"
    )


@query
def rating_fold_general(spark, sf_dir):
    """Everybody credited 90 minutes, every timeline split into weekly chunks."""
    gold = Gold.from_warehouse(spark, sf_dir, minutes_mode=lineup.FULL_90, chunk_days=7)
    return gold.rating_history.select("player_id", "match_id", "prior_matches", "rating", "rating_change")


@query
def rating_latest(spark, sf_dir):
    """Latest rating per player."""
    return Gold.from_warehouse(spark, sf_dir).latest_ratings


# --- chemistry ------------------------------------------------------------


@query
def player_distinct(spark, sf_dir):
    """Distinct player ids of the dimension."""
    return dimensions.distinct_player_ids(players(spark, sf_dir))


@query
def chemistry_init_pairs(spark, sf_dir):
    """Start edges of the pairs listed in one match."""
    return chemistry.chemistry_init(Gold.from_warehouse(spark, sf_dir).appearances)


@query
def pair_updates(spark, sf_dir):
    """Update of every pair of changed players per match."""
    return Gold.from_warehouse(spark, sf_dir).pair_updates.drop("kickoff", "match_day")


@query
def chemistry_final(spark, sf_dir):
    """Edges after all matches."""
    return Gold.from_warehouse(spark, sf_dir).chemistry


# --- match summaries ------------------------------------------------------


def _summaries(spark, sf_dir):
    return Gold.from_warehouse(spark, sf_dir).match_summaries


@query
def match_summary_core(spark, sf_dir):
    """Scalar fields and list lengths of the match summaries."""
    return _summaries(spark, sf_dir).select(
        "date", "label", "match_id", "duration", "winner", "venue", "gameweek",
        *[F.size(c).alias(f"n_{c}") for c in ("goals", "own_goals", "yellow_cards", "red_cards")],
    )


@query
def match_goals(spark, sf_dir):
    """Goals in listing order."""
    return summary.scorers(_summaries(spark, sf_dir), "goals")


@query
def match_own_goals(spark, sf_dir):
    """Own goals in listing order."""
    return summary.scorers(_summaries(spark, sf_dir), "own_goals")


@query
def match_cards(spark, sf_dir):
    """Cards in listing order."""
    return summary.cards(_summaries(spark, sf_dir))


# --- answers --------------------------------------------------------------


def _prediction_requests(spark, sf_dir, counts):
    return warehouse.prediction_requests(users(counts), players(spark, sf_dir), teams(spark, sf_dir))


def _event_lineups(spark, sf_dir):
    asked = _prediction_requests(spark, sf_dir, raw_events(spark, sf_dir).select(F.col("user_id").alias("player_id")))
    return prediction.lineups(asked, players(spark, sf_dir))


@query
def formation_check(spark, sf_dir):
    """Role counts and validity of the requested line-ups."""
    return prediction.formation_check(_event_lineups(spark, sf_dir))


def _asked(spark, sf_dir):
    """The requested line-ups, and everything rated and paired for their players alone."""
    gold = Gold.from_warehouse(spark, sf_dir)
    requested = _prediction_requests(spark, sf_dir, gold.counts)
    members = prediction.lineups(requested, players(spark, sf_dir))
    return requested, members, gold.among(members)


@query
def player_mean_chemistry(spark, sf_dir):
    """Mean chemistry of each requested player with the team mates."""
    _, members, gold = _asked(spark, sf_dir)
    return prediction.mean_chemistry(members, gold.chemistry)


@query
def team_strength(spark, sf_dir):
    """Strength of the requested teams."""
    _, members, gold = _asked(spark, sf_dir)
    return prediction.team_strength(members, gold.chemistry, gold.latest_ratings)


@query
def win_prediction(spark, sf_dir):
    """Winning chances for all requested pairs of teams."""
    requested, _, gold = _asked(spark, sf_dir)
    return prediction.predict(requested, players(spark, sf_dir), gold.latest_ratings, gold.chemistry)


def _name_requests(spark, sf_dir):
    """One request per customer name and one unknown name per customer segment."""
    customer = warehouse.table(spark, sf_dir, "customer")
    known = customer.select(F.col("c_custkey").alias("req_id"), F.col("c_name").alias("name"))
    unknown = customer.groupBy("c_mktsegment").agg((-1 - F.min("c_custkey")).alias("req_id")).select(
        "req_id", F.col("c_mktsegment").alias("name")
    )
    return known.unionByName(unknown)


@query
def profile_answer(spark, sf_dir):
    """Career profile of every named player."""
    profiles = stats.player_profiles(stats.player_match_stats(facts(spark, sf_dir)))
    return answers.profile_answers(_name_requests(spark, sf_dir), players(spark, sf_dir), profiles)


@query
def match_rate_answer(spark, sf_dir):
    """Last match performance of every named player."""
    latest = ratings.latest_ratings(Gold.from_warehouse(spark, sf_dir).match_ratings.withColumns(
        {"rating": F.lit(None).cast("double"), "rating_change": F.lit(None).cast("double")}
    ))
    return answers.rating_answers(_name_requests(spark, sf_dir), players(spark, sf_dir), latest)


def _published(spark, sf_dir, root):
    """Dimensions as CSV, requests as JSON documents and the results as a snapshot, as a second program finds them."""
    players(spark, sf_dir).write.option("header", True).csv(f"{root}/players")
    teams(spark, sf_dir).write.option("header", True).csv(f"{root}/teams")
    customer = warehouse.table(spark, sf_dir, "customer")
    names = customer.groupBy("c_mktsegment").agg(F.min("c_name").alias("name")).select("name").unionByName(teams(spark, sf_dir).select("name"))
    asked = names.select(F.explode(F.array(F.lit(2), F.lit(4))).alias("req_type"), "name")
    # a folder, hence a file, for each request
    asked.select(F.md5(F.concat_ws("/", "req_type", "name")).alias("request"), F.to_json(F.struct("req_type", "name")).alias("value")).write.partitionBy(
        "request"
    ).text(f"{root}/requests")
    catalog = Catalog(spark, f"{root}/store")
    Gold.from_warehouse(spark, sf_dir).publish(catalog, 1)
    return catalog


def _stored_answers(spark, sf_dir, kind):
    root = scratch_path(spark, "published")
    catalog = _published(spark, sf_dir, root)
    answered = catalog.answer(
        requests.read_requests(spark, f"{root}/requests/*"),
        dimensions.read_players(spark, f"{root}/players"), dimensions.read_teams(spark, f"{root}/teams"),
    )
    write_responses({kind: answered[kind]}, f"{root}/answers")
    return spark.read.schema(answered[kind].schema).json(f"{root}/answers/{kind}").drop("req_id")


@query
def stored_profile_answer(spark, sf_dir):
    """Profiles answered from published results, for request files, and read back from the responses."""
    return _stored_answers(spark, sf_dir, "profile")


@query
def stored_match_rate_answer(spark, sf_dir):
    """Last match performance answered from published results in the same way."""
    return _stored_answers(spark, sf_dir, "match_rate")


def _answered_documents(spark, sf_dir, kind, documents):
    """Answers to a table of request documents from published results."""
    catalog = Catalog(spark, scratch_path(spark, "published"))
    gold = Gold.from_warehouse(spark, sf_dir)
    gold.publish(catalog, 1)
    asked = requests.parse_requests(documents(gold))
    return catalog.answer(asked, players(spark, sf_dir), teams(spark, sf_dir))[kind]


@query
def stored_match_details(spark, sf_dir):
    """Details of every match, asked by date and label, from published results."""
    def documents(gold):
        body = F.to_json(F.struct("date", "label"))
        return gold.match_summaries.select(F.col("match_id").alias("req_id"), body.alias("value"))

    return _answered_documents(spark, sf_dir, "details", documents).select(
        "req_id", "date", "label", "duration", "winner", "gameweek", "venue",
        *[F.size(c).alias(f"n_{c}") for c in ("goals", "own_goals", "yellow_cards", "red_cards")], "error",
    )


@query
def stored_win_prediction(spark, sf_dir):
    """Winning chances for all requested pairs of teams, from published results."""
    def side(team):
        named = [F.col(f"{team}.players")[i].alias(f"player{i + 1}") for i in range(formulas.LINEUP_SIZE)]
        return F.struct(F.col(f"{team}.name").alias("name"), *named).alias(team)

    def documents(gold):
        asked = _prediction_requests(spark, sf_dir, gold.counts)
        return asked.select("req_id", F.to_json(F.struct(F.lit(1).alias("req_type"), side("team1"), side("team2"))).alias("value"))

    return _answered_documents(spark, sf_dir, "predict", documents)


def _match_answers(spark, sf_dir):
    summaries = materialize(_summaries(spark, sf_dir), "match_summaries")
    asked = summaries.select(F.col("match_id").alias("req_id"), "date", "label")
    return answers.match_answers(asked, summaries, players(spark, sf_dir), teams(spark, sf_dir))


@query
def match_details_answer(spark, sf_dir):
    """Details of every match with the winner's name and list lengths."""
    return _match_answers(spark, sf_dir).select(
        "req_id", "date", "label", "duration", "winner", "gameweek", "venue",
        *[F.size(c).alias(f"n_{c}") for c in ("goals", "own_goals", "yellow_cards", "red_cards")], "error",
    )


@query
def goal_names_answer(spark, sf_dir):
    """Scorers with names, in listing order."""
    kinds = F.map_from_arrays(F.array(F.lit("goals"), F.lit("own_goals")), F.array("goals", "own_goals"))
    return (
        _match_answers(spark, sf_dir)
        .select("req_id", F.explode(kinds).alias("kind", "items"))
        .select("req_id", "kind", F.posexplode("items").alias("pos", "g"))
        .select("req_id", "kind", "pos", "g.name", "g.team", "g.number_of_goals")
    )


@query
def card_names_answer(spark, sf_dir):
    """Cards with names, in listing order."""
    kinds = F.map_from_arrays(
        F.array(F.lit("yellow"), F.lit("red")), F.array("yellow_cards", "red_cards")
    )
    return (
        _match_answers(spark, sf_dir)
        .select("req_id", F.explode(kinds).alias("card", "items"))
        .select("req_id", "card", F.posexplode("items").alias("pos", "name"))
    )


@query
def request_routing(spark, sf_dir):
    """Route of every request document; requests nobody answers have none."""
    documents = warehouse.request_documents(
        raw_events(spark, sf_dir).select(F.col("user_id").alias("player_id")).distinct()
    )
    parsed = requests.parse_requests(documents)
    return parsed.select("req_id", requests.route(F.col("req_type")).alias("answer"))


@query
def rejected_requests(spark, sf_dir):
    """Documents that are no JSON object, told apart from requests for unknown things."""
    documents = warehouse.request_documents(
        raw_events(spark, sf_dir).select(F.col("user_id").alias("player_id")).distinct()
    )
    # Every fifth document breaks off.
    broken = documents.withColumn("value", F.expr("if(req_id % 5 = 0, concat('{\"req_type\": ', req_id), value)"))
    return requests.rejected(requests.parse_requests(broken))


@query
def rejected_dimension_rows(spark, sf_dir):
    """Rows of a player file whose id is no number, beside those that the reader takes."""
    root = scratch_path(spark, "dimension")
    named = players(spark, sf_dir)
    named.selectExpr("if(Id % 7 = 0, concat('x', Id), CAST(Id AS STRING)) AS Id", "name", "role").write.option("header", True).csv(root)
    taken = dimensions.read_players(spark, root).selectExpr("CAST(Id AS STRING) AS id", "name", "'taken' AS fate")
    left = dimensions.rejected_rows(spark, root).selectExpr("Id AS id", "name", "'rejected' AS fate")
    return taken.unionByName(left)


# --- streams --------------------------------------------------------------


def _event_stream(spark, sf_dir):
    # Dealt by a hash, every file holds events of all days, and every micro-batch is late for the next.
    path = scratch_path(spark, "events")
    raw = raw_events(spark, sf_dir)
    raw.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    return spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 2).parquet(path)


def _line_stream(spark, lines_df, batches=2):
    """The lines as text files, read back in a number of micro-batches."""
    path = scratch_path(spark, "lines")
    lines_df.write.text(path)
    files = len(lines.read_lines(spark, path).inputFiles())
    return lines.stream_lines(spark, path, max(1, -(-files // batches)))


def _all_lines(spark, sf_dir):
    events = warehouse.event_line(warehouse.events(raw_events(spark, sf_dir)))
    return events.unionByName(match_lines(spark, sf_dir))


def _finish(stream):
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()


def _streamed(spark, sf_dir):
    catalog = Catalog(spark, scratch_path(spark, "stream"))
    _finish(driver.run_stream(_line_stream(spark, _all_lines(spark, sf_dir)), catalog, available_now=True))
    return catalog


def _stateful(spark, df, keys):
    path = scratch_path(spark, "state")
    _finish(stateful.start_updates(df, path))
    stateful.compact(spark, path, df.schema, keys)
    return stateful.current_rows(spark, path, df.schema, keys)


@query
def stream_player_match_counters(spark, sf_dir):
    """Counters per match and player from the state store, over files in no order of time."""
    counters = stateful.running_counters(warehouse.events(_event_stream(spark, sf_dir)))
    return _stateful(spark, counters, ["match_id", "player_id"])


@query
def stream_evicted_counters(spark, sf_dir):
    """The same with state evicted behind a watermark, late events in a table of corrections."""
    store = finalise.open_store(spark, scratch_path(spark, "evicted"))
    _finish(finalise.run_stream(warehouse.events(_event_stream(spark, sf_dir)), store, available_now=True))
    return finalise.counters(store).select("match_id", "player_id", "team_id", *COUNTERS)


@query
def stream_matches_played(spark, sf_dir):
    """Participations per player from a stream that sends every match line twice."""
    once = match_lines(spark, sf_dir)
    stream = _line_stream(spark, once.unionByName(once))
    records = lines.preferred_records(lines.parse_matches(lines.route_records(stream).matches))
    return stateful.match_counts(_stateful(spark, records, ["match_id"]))


@query
def stream_match_dedup(spark, sf_dir):
    """First summary per (date, label) from a stream that sends every match twice."""
    once = match_lines(spark, sf_dir)
    stream = _line_stream(spark, once.unionByName(once))
    matches = lines.parse_matches(lines.route_records(stream).matches)
    first = stateful.first_summaries(summary.summarise(matches))
    return _stateful(spark, first, ["date", "label"]).select(
        "date", "label", "match_id", F.size("goals").alias("n_goals")
    )


@query
def stream_profile(spark, sf_dir):
    """Career profiles kept up to date by the streaming pipeline."""
    return driver.player_profiles(_streamed(spark, sf_dir))


@query
def stream_rating_latest(spark, sf_dir):
    """Latest ratings kept up to date by the streaming pipeline."""
    return driver.latest_ratings(_streamed(spark, sf_dir))


@query
def stream_after_a_failure(spark, sf_dir):
    """Latest ratings after a writer that died before its commit, and a stream that went on from its checkpoint."""
    catalog = Catalog(spark, scratch_path(spark, "stream"))
    source = _line_stream(spark, _all_lines(spark, sf_dir))
    dead = catalog.store.begin(0)
    every = warehouse.counts(raw_events(spark, sf_dir))
    dead.write("player_count", every.selectExpr("*", "0L AS batch_id", "0 AS bucket"))
    dead.settle()
    _finish(driver.run_stream(source, catalog, available_now=True))
    _finish(driver.run_stream(source, catalog, available_now=True))
    return driver.latest_ratings(catalog)


@query
def stream_chemistry(spark, sf_dir):
    """Chemistry kept up to date by the streaming pipeline."""
    return driver.edges(_streamed(spark, sf_dir))
