import hashlib
import zlib

import pytest

from yieldcast.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, conv long, name string"


def brute(rows):
    """Nodes of the rebuilt conversations by plain dictionaries of prefixes."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(c - 20 * int(c / 20)), [])[:h] + own[c][h:])
    members = {}
    for c, w in whole.items():
        for d in range(len(w) + 1):
            members.setdefault(w[:d], []).append(c)
    out = []
    for k, cs in members.items():
        below = [x for x in members if x[:len(k)] == k]
        childless = [x for x in below if not any(y[:-1] == x for y in below if y != x and y)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].replace("\t", " ").replace("\n", " ").split(" ")) if x and x[-1][1].strip() else 0 for x in below)
        ends = ",".join(map(str, sorted(c for c in cs if whole[c] == k)))
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), sum(1 for x in below if len(x) == len(k) + 1),
                    len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in P.prefix_trie(P.with_shared_starts(P.numbered_turns(df))).collect()), key=str)


def test_random_conversations_match_brute_force(spark, rng):
    says = ["yes", "no", "two words", ""]
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(says)) for c in [*range(0, 70), 500, 501] for t in range(rng.choice([1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", "same") for c in range(100, 120) for t in range(6)]
    assert got(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_deep_conversations(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, "bot", "b"), (1, 0, "bot", "b"), (None, 1, "user", "lost"),
            (2, 5, "", ""), (20, 1, "user", "only"), (33, 1, "user", "a"), (-7, 3, "user", "x y"), (-20, 1, "bot", "z")]
    rows += [(40, t, "user", f"turn {t // 3}") for t in range(130)] + [(41, t, "user", f"turn {t // 3}") for t in range(130)]
    assert got(spark, rows) == brute(rows)


def test_turnless_conversations_belong_to_the_root(spark):
    rows = [(c, 0, "user", "hi") for c in range(21, 40)]          # their first conversation, 20, does not exist
    out = got(spark, rows)
    assert out == brute(rows) and any(r[1] == 0 and r[3] == 19 for r in out)


def test_a_long_list_of_ends_is_hashed_in_pieces(spark):
    rows = [(1000 * k, 0, "user", "same") for k in range(1, 700)]
    assert got(spark, rows, 5) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("depth, sizes", [(0, []), (1, [0]), (2, [0, 1]), (3, [0, 1]), (4, [0, 1, 2])])
def test_block_sizes(depth, sizes):
    assert P._sizes(depth) == sizes
