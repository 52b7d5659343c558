"""Small hand-written records for the tests."""

import json


def event(code, tags=(), player=11, match=5, team=2, sub=30, number=1, **extra):
    return {
        "eventId": code, "subEventId": sub, "tags": [{"id": t} for t in tags],
        "playerId": player, "matchId": match, "teamId": team, "id": number,
        "eventSec": 3.4, "matchPeriod": "1H", "eventName": "x", "subEventName": "y",
        "positions": [{"y": 1, "x": 2}], **extra,
    }


def member(player, goals="0", own="0", yellow="0", red="0"):
    return {"playerId": player, "goals": goals, "ownGoals": own, "yellowCards": yellow, "redCards": red}


def formation(lineup, bench=(), substitutions="null"):
    return {"formation": {"lineup": list(lineup), "bench": list(bench), "substitutions": substitutions}}


def match(number, teams, date="2018-03-01 15:00:00", label=None, winner=0, status="Suspended", week=1):
    return {
        "wyId": number, "status": status, "dateutc": date, "label": label or f"match {number}",
        "duration": "Regular", "winner": winner, "venue": "Ground", "gameweek": week, "teamsData": teams,
    }


def lines(spark, records):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(texts, "value STRING")


def season(days=5, matches=2):
    """A few matches a day between squads of six, with varied events."""
    out = []
    number = 0
    for day in range(days):
        for m in range(matches):
            match_id = 100 * (day + 1) + m
            squads = {t: [t * 10 + i for i in range(1, 7)] for t in (m * 2 + 1, m * 2 + 2)}
            teams = {}
            for t, ids in squads.items():
                subs = [{"playerIn": ids[5], "playerOut": ids[0], "minute": 50 + day}] if day % 3 else "null"
                teams[str(t)] = formation([member(p) for p in ids[:5]], [member(ids[5])], subs)
            out.append(match(match_id, teams, f"2018-03-{day + 1:02d} {12 + m}:00:00"))
            for t, ids in squads.items():
                for i, p in enumerate(ids):
                    for k in range((day + i + m) % 4):
                        number += 1
                        code = (8, 1, 10, 3, 2)[(number + day) % 5]
                        tags = [1801 if (number * 7 + k) % 3 else 1802, 701 + number % 3]
                        if number % 11 == 0:
                            tags.append(101)
                        out.append(event(code, tags, p, match_id, t, 35 if number % 2 else 30, number))
                out.append(event(8, [1801], 0, match_id, t, number=10_000 + number))
    return out
