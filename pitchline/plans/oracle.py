"""The same results in plain SQL over the warehouse tables.

The statements are written relationally from the definitions: conditions on the
warehouse columns instead of tag arrays, joins instead of nested records, and
row-by-row recursion instead of composed scans.
"""

from __future__ import annotations

from pitchline.operators.facts import COUNTERS
from pitchline.sources.warehouse import DAY_BASE

# name -> (names it reads, statement); order matters within a WITH clause.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, reads: tuple[str, ...], body: str) -> None:
    _CTES[name] = (reads, body)


def r6(expression: str) -> str:
    return f"round({expression} + 1.3e-10, 6)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def ratio(top: str, bottom: str) -> str:
    return f"coalesce(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 0.0)"


_cte("ev", (), f"""
    SELECT event_id, ts, user_id AS player_id, user_id // 22 AS bucket,
           datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
           datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) * {DAY_BASE} + user_id // 22 AS match_id,
           1 + (user_id // 11) % 20 AS team_id,
           CASE event_type WHEN 'click' THEN 8 WHEN 'view' THEN 1 WHEN 'purchase' THEN 10
                WHEN 'error' THEN 2 WHEN 'signup' THEN 3 END AS code,
           CAST(json_extract(props, '$.k') AS INT) AS k
    FROM events""")

_cte("facts", ("ev",), """
    SELECT event_id, match_id, day, bucket, team_id, player_id,
           CAST(code = 8 AND k < 60 AS INT) AS acc_pass,
           CAST(code = 8 AND k >= 60 AND k < 97 AS INT) AS inacc_pass,
           CAST(code = 8 AND k % 7 = 0 AND k < 60 AS INT) AS key_acc_pass,
           CAST(code = 8 AND k % 7 = 0 AND k >= 60 AND k < 97 AS INT) AS key_inacc_pass,
           CAST(code = 1 AND k % 3 = 0 AS INT) AS duel_lost,
           CAST(code = 1 AND k % 3 = 1 AS INT) AS duel_neutral,
           CAST(code = 1 AND k % 3 = 2 AS INT) AS duel_won,
           CAST(code = 3 AND k % 11 = 0 AND k % 5 = 0 AS INT) AS penalty,
           CAST(code = 3 AND k < 60 AS INT) AS fk_acc,
           CAST(code = 3 AND k >= 60 AND k < 97 AS INT) AS fk_inacc,
           CAST(code = 10 AND k % 11 = 0 AS INT) AS goal,
           CAST(code = 10 AND k < 60 AS INT) AS on_target,
           CAST(code = 10 AND k >= 60 AND k < 97 AS INT) AS off_target,
           CAST(code = 2 AS INT) AS fouls,
           CAST(k % 53 = 0 AS INT) AS own_goal
    FROM ev""")

_SUMS = ", ".join(f"{big(f'sum({c})')} AS {c}" for c in COUNTERS)

_cte("counted", ("facts",), f"""
    SELECT match_id, day, bucket, player_id, max(team_id) AS team_id, {_SUMS}
    FROM facts GROUP BY match_id, day, bucket, player_id""")

_cte("stats", ("counted",), f"""
    SELECT *, {ratio('acc_pass + key_acc_pass', 'acc_pass + inacc_pass + key_acc_pass + key_inacc_pass')} AS pass_accuracy,
           {ratio('duel_won + 0.5 * duel_neutral', 'duel_won + duel_lost + duel_neutral')} AS duel_effectiveness,
           {ratio('fk_acc + penalty', 'fk_acc + fk_inacc')} AS fk_effectiveness,
           {ratio('goal + 0.5 * (on_target - goal)', 'on_target + off_target + goal')} AS shots_on_target,
           acc_pass + key_acc_pass AS pass_num,
           acc_pass + inacc_pass + key_acc_pass + key_inacc_pass AS pass_tot
    FROM counted WHERE player_id <> 0""")

_cte("users", ("ev",), "SELECT DISTINCT player_id, bucket FROM ev")

_cte("games", ("ev",), "SELECT DISTINCT match_id, day, bucket FROM ev")

# Every user of a bucket is listed in every match of the bucket.
_cte("listed", ("users", "games", "counted"), """
    SELECT g.match_id, g.day, g.bucket, u.player_id, u.player_id % 11 AS slot_no,
           (u.player_id // 11) % 2 AS team_pos, 1 + (u.player_id // 11) % 20 AS team_id,
           CASE WHEN u.player_id % 11 <= 7 THEN 'lineup' ELSE 'bench' END AS slot,
           CASE WHEN u.player_id % 11 <= 7 THEN 1 ELSE 0 END AS slot_pos,
           coalesce(c.goal, 0) AS goal, coalesce(c.own_goal, 0) AS own_goal, coalesce(c.fouls, 0) AS fouls
    FROM games g JOIN users u ON u.bucket = g.bucket
    LEFT JOIN counted c ON c.match_id = g.match_id AND c.player_id = u.player_id""")

_cte("subs", ("listed",), """
    SELECT b.match_id, b.player_id AS player_in, l.player_id AS player_out,
           46 + (b.day + b.team_id) % 39 + CASE WHEN b.slot_no = 9 THEN 5 ELSE 0 END AS at
    FROM listed b JOIN listed l ON l.match_id = b.match_id AND l.team_pos = b.team_pos
     AND l.slot_no = b.slot_no - 8
    WHERE b.slot_no IN (8, 9) AND b.day % 7 <> 3""")

_cte("onfield", ("listed", "subs"), """
    SELECT l.match_id, l.day, l.player_id, l.team_id, l.team_pos, l.slot,
           CASE WHEN l.slot = 'lineup' THEN 0 ELSE coalesce(i.at, -1) END AS minute_in,
           CASE WHEN l.slot = 'lineup' THEN coalesce(o.at, 90) WHEN i.at IS NULL THEN -1 ELSE 90 END AS minute_out,
           CASE WHEN l.slot = 'lineup' THEN coalesce(o.at, 90) ELSE coalesce(90 - i.at, 0) END AS on_minutes,
           l.slot = 'lineup' OR i.at IS NOT NULL AS participated
    FROM listed l
    LEFT JOIN subs i ON i.match_id = l.match_id AND i.player_in = l.player_id
    LEFT JOIN subs o ON o.match_id = l.match_id AND o.player_out = l.player_id""")

_cte("full90", ("onfield",), """
    SELECT * REPLACE (CASE WHEN day % 5 <> 0 THEN 90 ELSE on_minutes END AS on_minutes) FROM onfield""")

_cte("played", ("onfield",), """
    SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY day, match_id) - 1 AS prior
    FROM onfield WHERE participated""")

_cte("played90", ("full90",), """
    SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY day, match_id) - 1 AS prior
    FROM full90 WHERE participated""")


def _performance(minutes: str) -> str:
    base = "(0.4 * pass_accuracy + 0.3 * duel_effectiveness + 0.1 * shots_on_target + 0.2 * fk_effectiveness)"
    contribution = f"(CASE WHEN {minutes} = 90 THEN {base} * 1.05 ELSE {base} * {minutes} / 90.0 END)"
    return f"0.5 + 0.5 * ({contribution} - 0.005 * fouls * {contribution} - 0.05 * own_goal * {contribution})"


for _suffix, _minutes in (("", "played"), ("90", "played90")):
    _cte(f"rated{_suffix}", (_minutes, "stats"), f"""
        SELECT p.player_id, p.match_id, p.day, s.team_id, p.on_minutes, p.prior,
               {_performance('p.on_minutes')} AS mr,
               row_number() OVER (PARTITION BY p.player_id ORDER BY p.day, p.match_id) AS nth
        FROM {_minutes} p JOIN stats s ON s.match_id = p.match_id AND s.player_id = p.player_id""")
    _cte(f"history{_suffix}", (f"rated{_suffix}",), f"""
        SELECT player_id, match_id, day, team_id, prior, mr, nth, CAST(0.5 AS DOUBLE) AS old,
               (mr + 0.5 * prior) / (1 + prior) AS rating
        FROM rated{_suffix} WHERE nth = 1
        UNION ALL
        SELECT m.player_id, m.match_id, m.day, m.team_id, m.prior, m.mr, m.nth, h.rating,
               (m.mr + h.rating * m.prior) / (1 + m.prior)
        FROM history{_suffix} h JOIN rated{_suffix} m ON m.player_id = h.player_id AND m.nth = h.nth + 1""")

_cte("latest", ("history",), """
    SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY nth DESC) = 1""")

_cte("moves", ("history",), """
    SELECT match_id, day, player_id, team_id, rating - old AS change FROM history
    WHERE abs(rating - old) > 1e-9""")

_cte("updates", ("moves",), """
    SELECT a.match_id, a.day, a.player_id AS player_lo, b.player_id AS player_hi,
           abs(a.change + b.change) / 2 AS delta,
           (a.team_id = b.team_id) = (sign(a.change) = sign(b.change)) AS up,
           row_number() OVER (PARTITION BY a.player_id, b.player_id ORDER BY a.day, a.match_id) AS nth
    FROM moves a JOIN moves b ON b.match_id = a.match_id AND a.player_id < b.player_id""")

_cte("edges", ("updates",), """
    SELECT player_lo, player_hi, nth, CASE WHEN up THEN 0.5 + delta * 0.5 ELSE 0.5 - delta * 0.5 END AS c
    FROM updates WHERE nth = 1
    UNION ALL
    SELECT u.player_lo, u.player_hi, u.nth, CASE WHEN u.up THEN e.c + u.delta * (1 - e.c) ELSE e.c - u.delta * e.c END
    FROM edges e JOIN updates u ON u.player_lo = e.player_lo AND u.player_hi = e.player_hi AND u.nth = e.nth + 1""")

_cte("chem", ("edges",), """
    SELECT player_lo, player_hi, c AS chemistry FROM edges
    QUALIFY row_number() OVER (PARTITION BY player_lo, player_hi ORDER BY nth DESC) = 1""")

_cte("header", ("listed", "games"), """
    SELECT g.match_id, CAST(DATE '2024-01-01' + CAST(g.day AS INT) AS VARCHAR) AS date,
           'B' || g.bucket || ' day ' || g.day AS label, 'Regular' AS duration,
           CASE WHEN t.g0 > t.g1 THEN 1 + (2 * g.bucket) % 20 WHEN t.g1 > t.g0 THEN 1 + (2 * g.bucket + 1) % 20 ELSE 0 END AS winner,
           'Ground ' || (1 + (2 * g.bucket) % 20) AS venue, g.day // 7 + 1 AS gameweek,
           t.n_goals, t.n_own_goals, t.n_yellow_cards, t.n_red_cards
    FROM games g JOIN (
        SELECT match_id, coalesce(sum(goal) FILTER (team_pos = 0), 0) AS g0, coalesce(sum(goal) FILTER (team_pos = 1), 0) AS g1,
               count(*) FILTER (goal > 0) AS n_goals, count(*) FILTER (own_goal > 0) AS n_own_goals,
               count(*) FILTER (slot_no <> 10 AND fouls >= 2) AS n_yellow_cards,
               count(*) FILTER (fouls >= 4) AS n_red_cards
        FROM listed GROUP BY match_id) t ON t.match_id = g.match_id""")


def _in_order(where: str) -> str:
    return f"""
        SELECT match_id, player_id, team_id, goal, own_goal,
               row_number() OVER (PARTITION BY match_id ORDER BY team_pos, slot_pos, player_id) - 1 AS pos
        FROM listed WHERE {where}"""


_cte("goals", ("listed",), _in_order("goal > 0"))
_cte("own_goals", ("listed",), _in_order("own_goal > 0"))
_cte("yellow", ("listed",), _in_order("slot_no <> 10 AND fouls >= 2"))
_cte("red", ("listed",), _in_order("fouls >= 4"))

_cte("asked", ("users",), """
    SELECT u.bucket AS req_id, (u.player_id // 11) % 2 + 1 AS team, u.player_id, c.c_custkey % 11 AS role_no
    FROM users u JOIN customer c ON c.c_custkey = u.player_id
    WHERE u.bucket IN (SELECT bucket FROM users u2 JOIN customer c2 ON c2.c_custkey = u2.player_id
                       GROUP BY bucket HAVING count(*) = 22)""")

_cte("means", ("asked", "chem"), """
    SELECT a.req_id, a.team, a.player_id, sum(coalesce(c.chemistry, 0.5)) / 10 AS mean_chemistry
    FROM asked a JOIN asked b ON b.req_id = a.req_id AND b.team = a.team AND b.player_id <> a.player_id
    LEFT JOIN chem c ON c.player_lo = least(a.player_id, b.player_id) AND c.player_hi = greatest(a.player_id, b.player_id)
    GROUP BY a.req_id, a.team, a.player_id""")

_cte("strength", ("means", "latest"), """
    SELECT m.req_id, m.team, sum(m.mean_chemistry * coalesce(l.rating, 1.0)) AS strength
    FROM means m LEFT JOIN latest l ON l.player_id = m.player_id GROUP BY m.req_id, m.team""")

_cte("formation", ("asked",), """
    SELECT req_id, team, count(*) FILTER (role_no = 0) AS gk, count(*) FILTER (role_no BETWEEN 1 AND 4) AS df,
           count(*) FILTER (role_no BETWEEN 5 AND 8) AS md, count(*) FILTER (role_no >= 9) AS fw
    FROM asked GROUP BY req_id, team""")

_cte("profiles", ("stats",), f"""
    SELECT player_id, {big('sum(fouls)')} AS fouls, {big('sum(goal)')} AS goals, {big('sum(own_goal)')} AS own_goals,
           {big('sum(pass_num)')} AS pass_num, {big('sum(pass_tot)')} AS pass_tot,
           sum(shots_on_target) AS shots_target_sum, avg(shots_on_target) AS shots_target_avg,
           {ratio('sum(pass_num)', 'sum(pass_tot)')} AS pass_accuracy
    FROM stats GROUP BY player_id""")

_cte("filed", (), """
    SELECT min(c_name) AS name FROM customer GROUP BY c_mktsegment UNION ALL SELECT n_name FROM nation""")

_cte("named", (), """
    SELECT c_custkey AS req_id, c_name AS name FROM customer
    UNION ALL SELECT -1 - min(c_custkey), c_mktsegment FROM customer GROUP BY c_mktsegment""")

_cte("roles", (), """
    SELECT c_custkey AS Id, c_name AS name,
           CASE WHEN c_custkey % 11 = 0 THEN 'GK' WHEN c_custkey % 11 <= 4 THEN 'DF'
                WHEN c_custkey % 11 <= 8 THEN 'MD' ELSE 'FW' END AS role
    FROM customer""")


def _statement(select: str, *reads: str) -> str:
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for other in _CTES[name][0]:
            visit(other)
        needed.append(name)

    for name in reads:
        visit(name)
    if not needed:
        return select
    parts = ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in needed)
    return f"WITH RECURSIVE {parts}\n{select}"


_N = "event_id"
_CUT = f"({_N} % 97 = 0 OR {_N} % 89 = 0 OR {_N} % 83 = 0)"
_KEYED = f"({_N} % 79 = 0 OR {_N} % 73 = 0 OR {_N} % 71 = 0)"
_DEAD = f"({_CUT} OR (NOT {_KEYED} AND ({_N} % 67 = 0 OR {_N} % 61 = 0 OR {_N} % 59 = 0)))"
_NULL_ID = f"(NOT {_DEAD} AND {_N} % 79 = 0)"
_BOTH = f"(NOT {_DEAD} AND {_N} % 79 <> 0 AND {_N} % 73 = 0)"
_NEITHER = f"(NOT {_DEAD} AND {_N} % 79 <> 0 AND {_N} % 73 <> 0 AND {_N} % 71 = 0)"
_MATCH = f"(NOT {_DEAD} AND {_N} % 79 <> 0 AND {_N} % 73 <> 0 AND {_N} % 71 <> 0 AND {_N} % 11 = 0)"

_TAGS = [
    (1801, "k < 60"), (1802, "k >= 60 AND k < 97"), (302, "k % 7 = 0"), (701, "k % 3 = 0"),
    (702, "k % 3 = 1"), (703, "k % 3 = 2"), (101, "k % 11 = 0"), (102, "k % 53 = 0"),
]

_COUNTS = ", ".join(big(c) + f" AS {c}" for c in COUNTERS)
_APPEARANCE = (
    f"SELECT match_id, player_id, {big('team_id')} AS team_id, {big('team_pos')} AS team_pos, slot, "
    f"{big('minute_in')} AS minute_in, {big('minute_out')} AS minute_out, {big('on_minutes')} AS minutes, participated FROM "
)
_SECOND = "CASE WHEN hour(ts) < 12 THEN 0 ELSE 3600000000 END + epoch_us(ts) % 2700000000"
_KICKOFF = "epoch_us(CAST(DATE '2024-01-01' + CAST(day AS INT) AS TIMESTAMP) + INTERVAL 15 HOUR)"
_TIMED = f"CASE WHEN day % 6 <> 4 THEN {_KICKOFF} END"
_LISTS = ("n_goals", "n_own_goals", "n_yellow_cards", "n_red_cards")
_COUNTED_LISTS = ", ".join(big(f"h.{c}") + f" AS {c}" for c in _LISTS)

ORACLE: dict[str, str] = {
    "route_match_lines": f"SELECT event_id AS line_no FROM events WHERE {_NULL_ID} OR {_BOTH} OR {_MATCH}",
    "route_event_lines": f"SELECT event_id AS line_no FROM events WHERE NOT ({_DEAD} OR {_NULL_ID} OR {_NEITHER} OR {_MATCH})",
    "dead_letter_lines": f"""SELECT CASE WHEN {_N} % 97 = 0 THEN 'junk{{' || {_N} WHEN {_N} % 89 = 0 THEN '[' || {_N} || ']'
        WHEN {_N} % 83 = 0 THEN '{{"eventId":8,"id":' || {_N} WHEN {_N} % 67 = 0 THEN '{{"eventId":8,"id":' || {_N} || '}} trailing'
        WHEN {_N} % 61 = 0 THEN '{{"eventId":8,"id":' || {_N} || '}}{{"eventId":9}}'
        ELSE '{{"wyId":' || {_N} || '}},{{"wyId":1}}' END AS value FROM events WHERE {_DEAD}""",
    "event_tags_exploded": _statement(
        " UNION ALL ".join(
            f"SELECT event_id, {big('code')} AS event_code, {big('CASE WHEN k % 5 = 0 THEN 35 ELSE 30 END')} AS sub_event, {big(str(tag))} AS tag_id FROM ev WHERE {where}"
            for tag, where in _TAGS
        ), "ev"),
    "event_counters": _statement(f"SELECT event_id, match_id, player_id, {_COUNTS} FROM facts", "facts"),
    "event_match_times": _statement(
        f"SELECT match_id, count(*) AS events, {big(f'min({_TIMED} + {_SECOND})')} AS first_micros, "
        f"{big(f'max({_TIMED} + {_SECOND})')} AS last_micros FROM ev GROUP BY match_id", "ev"),
    "player_match_counters": _statement(
        f"SELECT match_id, player_id, {big('team_id')} AS team_id, {', '.join(COUNTERS)} FROM counted WHERE player_id <> 0", "counted"),
    "player_match_ratios": _statement(
        "SELECT match_id, player_id, "
        + ", ".join(f"{r6(c)} AS {c}" for c in ("pass_accuracy", "duel_effectiveness", "fk_effectiveness", "shots_on_target"))
        + ", pass_num, pass_tot FROM stats", "stats"),
    "career_profile": _statement(
        f"SELECT player_id, fouls, goals, own_goals, pass_num, pass_tot, {r6('shots_target_sum')} AS shots_target_sum, "
        f"{r6('shots_target_avg')} AS shots_target_avg, {r6('pass_accuracy')} AS pass_accuracy FROM profiles", "profiles"),
    "match_team_ids": _statement(
        " UNION ALL ".join(
            f"SELECT match_id, {big(str(pos))} AS team_pos, {big(f'1 + (2 * bucket + {pos}) % 20')} AS team_id FROM games" for pos in (0, 1)
        ), "games"),
    "appearances_on_field": _statement(_APPEARANCE + "onfield", "onfield"),
    "appearances_full_90": _statement(_APPEARANCE + "full90", "full90"),
    "matches_played": _statement("SELECT player_id, count(*) AS matches_played FROM played WHERE player_id <> 0 GROUP BY player_id", "played"),
    "prior_match_ordinal": _statement("SELECT match_id, player_id, prior AS prior_matches FROM played", "played"),
    "match_rating": _statement(
        f"SELECT match_id, player_id, {big('team_id')} AS team_id, {big('on_minutes')} AS minutes, prior AS prior_matches, {r6('mr')} AS match_rating FROM rated", "rated"),
    "rating_running_mean": _statement(
        f"""SELECT player_id, match_id, {r6('mr')} AS match_rating, {r6('rating')} AS rating,
            {r6('rating - coalesce(lag(rating) OVER (PARTITION BY player_id ORDER BY match_id), 0.5)')} AS rating_change
            FROM (SELECT *, avg(mr) OVER (PARTITION BY player_id ORDER BY match_id ROWS UNBOUNDED PRECEDING) AS rating
                  FROM (SELECT player_id, match_id, {_performance('90')} AS mr FROM stats))""", "stats"),
    "rating_history": _statement(
        f"SELECT player_id, match_id, prior AS prior_matches, {r6('mr')} AS match_rating, {r6('rating')} AS rating, {r6('rating - old')} AS rating_change FROM history", "history"),
    "rating_fold_general": _statement(
        f"SELECT player_id, match_id, prior AS prior_matches, {r6('rating')} AS rating, {r6('rating - old')} AS rating_change FROM history90", "history90"),
    "rating_latest": _statement(
        f"SELECT player_id, match_id, {big('team_id')} AS team_id, {r6('mr')} AS match_rating, {r6('rating')} AS rating, {r6('rating - old')} AS rating_change FROM latest", "latest"),
    "player_distinct": "SELECT DISTINCT c_custkey AS Id FROM customer",
    "chemistry_init_pairs": _statement(
        """SELECT DISTINCT a.player_id AS player_lo, b.player_id AS player_hi, CAST(0.5 AS DOUBLE) AS chemistry
           FROM listed a JOIN listed b ON b.match_id = a.match_id AND a.player_id < b.player_id WHERE a.player_id <> 0""", "listed"),
    "pair_updates": _statement(f"SELECT match_id, player_lo, player_hi, {r6('delta')} AS delta, up FROM updates", "updates"),
    "chemistry_final": _statement(f"SELECT player_lo, player_hi, {r6('chemistry')} AS chemistry FROM chem", "chem"),
    "match_summary_core": _statement(
        f"SELECT date, label, match_id, duration, {big('winner')} AS winner, venue, {big('gameweek')} AS gameweek, {_COUNTED_LISTS} FROM header h", "header"),
    "match_goals": _statement(
        f"SELECT date, label, pos, player_id, {big('team_id')} AS team_id, {big('goal')} AS goals FROM goals JOIN header USING (match_id)", "goals", "header"),
    "match_own_goals": _statement(
        f"SELECT date, label, pos, player_id, {big('team_id')} AS team_id, {big('own_goal')} AS goals FROM own_goals JOIN header USING (match_id)", "own_goals", "header"),
    "match_cards": _statement(
        """SELECT date, label, card, pos, player_id FROM (
             SELECT 'yellow' AS card, * FROM yellow UNION ALL SELECT 'red', * FROM red) JOIN header USING (match_id)""", "yellow", "red", "header"),
    "formation_check": _statement(
        f"SELECT req_id, {big('team')} AS team, gk, df, md, fw, gk = 1 AND df >= 3 AND md >= 2 AND fw >= 1 AS valid FROM formation", "formation"),
    "player_mean_chemistry": _statement(
        f"SELECT req_id, {big('team')} AS team, player_id, {r6('mean_chemistry')} AS mean_chemistry FROM means", "means"),
    "team_strength": _statement(f"SELECT req_id, {big('team')} AS team, {r6('strength')} AS strength FROM strength", "strength"),
    "win_prediction": _statement(
        f"""SELECT s.req_id, {big('s.team')} AS team, n_name AS name,
            {r6('(0.5 + (s.strength - o.strength) / nullif(s.strength + o.strength, 0)) * 100')} AS winning_chance,
            gk = 1 AND df >= 3 AND md >= 2 AND fw >= 1 AS valid, CAST(NULL AS VARCHAR) AS error
            FROM strength s JOIN strength o ON o.req_id = s.req_id AND o.team <> s.team
            JOIN formation f ON f.req_id = s.req_id AND f.team = s.team
            JOIN nation ON n_nationkey = 1 + (2 * s.req_id + s.team - 1) % 20""", "strength", "formation"),
    "profile_answer": _statement(
        f"""SELECT r.Id, n.name, n.req_id, r.role, p.fouls, p.goals, p.own_goals, {r6('p.pass_accuracy')} AS percent_pass_accuracy,
            {r6('p.shots_target_avg')} AS percent_shots_on_target,
            CASE WHEN r.Id IS NULL THEN 'unknown player' WHEN p.player_id IS NULL THEN 'no profile' END AS error
            FROM named n LEFT JOIN roles r ON r.name = n.name LEFT JOIN profiles p ON p.player_id = r.Id""", "named", "roles", "profiles"),
    "stored_profile_answer": _statement(
        f"""SELECT r.Id, n.name, r.role, p.fouls, p.goals, p.own_goals, {r6('p.pass_accuracy')} AS percent_pass_accuracy,
            {r6('p.shots_target_avg')} AS percent_shots_on_target,
            CASE WHEN r.Id IS NULL THEN 'unknown player' WHEN p.player_id IS NULL THEN 'no profile' END AS error
            FROM filed n LEFT JOIN roles r ON r.name = n.name LEFT JOIN profiles p ON p.player_id = r.Id""", "filed", "roles", "profiles"),
    "stored_match_rate_answer": _statement(
        f"""SELECT n.name, {r6('10 * l.mr')} AS performance,
            CASE WHEN r.Id IS NULL THEN 'unknown player' WHEN l.player_id IS NULL THEN 'no match rating' END AS error
            FROM filed n LEFT JOIN roles r ON r.name = n.name
            LEFT JOIN (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY nth DESC) = 1) l
              ON l.player_id = r.Id""", "filed", "roles", "rated"),
    "match_rate_answer": _statement(
        f"""SELECT n.req_id, n.name, {r6('10 * l.mr')} AS performance,
            CASE WHEN r.Id IS NULL THEN 'unknown player' WHEN l.player_id IS NULL THEN 'no match rating' END AS error
            FROM named n LEFT JOIN roles r ON r.name = n.name
            LEFT JOIN (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY nth DESC) = 1) l
              ON l.player_id = r.Id""", "named", "roles", "rated"),
    "match_details_answer": _statement(
        f"""SELECT h.match_id AS req_id, h.date, h.label, h.duration, n_name AS winner, {big('h.gameweek')} AS gameweek, h.venue,
            {_COUNTED_LISTS}, CAST(NULL AS VARCHAR) AS error
            FROM header h LEFT JOIN nation ON n_nationkey = h.winner AND h.winner <> 0""", "header"),
    "goal_names_answer": _statement(
        f"""SELECT match_id AS req_id, kind, pos, c_name AS name, n_name AS team, {big('n')} AS number_of_goals FROM (
              SELECT 'goals' AS kind, *, goal AS n FROM goals UNION ALL SELECT 'own_goals', *, own_goal FROM own_goals) g
            LEFT JOIN customer ON c_custkey = g.player_id LEFT JOIN nation ON n_nationkey = g.team_id""", "goals", "own_goals"),
    "card_names_answer": _statement(
        """SELECT match_id AS req_id, card, pos, c_name AS name FROM (
             SELECT 'yellow' AS card, * FROM yellow UNION ALL SELECT 'red', * FROM red) g
           LEFT JOIN customer ON c_custkey = g.player_id""", "yellow", "red"),
    "request_routing": _statement(
        """SELECT player_id AS req_id, CASE player_id % 7 WHEN 1 THEN 'predict' WHEN 2 THEN 'profile' WHEN 4 THEN 'match_rate'
             WHEN 5 THEN NULL ELSE 'details' END AS answer FROM users""", "users"),
}

ORACLE["rejected_requests"] = _statement(
    """SELECT player_id AS req_id, '{"req_type": ' || player_id AS document, 'not a JSON object' AS error
       FROM users WHERE player_id % 5 = 0""", "users")
ORACLE["rejected_dimension_rows"] = """
    SELECT CASE WHEN c_custkey % 7 = 0 THEN 'x' || c_custkey ELSE c_custkey::VARCHAR END AS id, c_name AS name,
           CASE WHEN c_custkey % 7 = 0 THEN 'rejected' ELSE 'taken' END AS fate FROM customer"""
ORACLE["stream_player_match_counters"] = ORACLE["player_match_counters"]
ORACLE["stream_matches_played"] = ORACLE["matches_played"]
ORACLE["stream_profile"] = ORACLE["career_profile"]
ORACLE["stream_rating_latest"] = ORACLE["rating_latest"]
ORACLE["stream_evicted_counters"] = ORACLE["player_match_counters"]
ORACLE["stream_after_a_failure"] = ORACLE["rating_latest"]
ORACLE["stored_match_details"] = ORACLE["match_details_answer"]
ORACLE["stored_win_prediction"] = ORACLE["win_prediction"]
ORACLE["stream_chemistry"] = ORACLE["chemistry_final"]
ORACLE["stream_match_dedup"] = _statement(
    f"SELECT date, label, match_id, {big('n_goals')} AS n_goals FROM header", "header")
