"""Contexts of personal data: spreading, and the graph rounds against plain loops."""

import math
import random
from collections import defaultdict

from secflow.llm import personal


def _plain(cands, rounds, min_score, min_seeds):
    edges = defaultdict(int)
    for c, v, s in cands:
        if s >= 0 or sum(ch.isdigit() and ch.isascii() for ch in v) >= personal.MIN_DIGITS:
            edges[c, v] = max(edges.get((c, v), -1), s)
    by = defaultdict(list)
    for (c, v), s in edges.items():
        by[c].append((v, s))
    promoted, passed = {}, {}
    for _ in range(rounds):
        now = {}
        for c, held in by.items():
            for kind in range(4):
                marks = [1.0 if s == kind else 0.0 if s >= 0 else promoted.get((v, kind), 0.0) for v, s in held]
                score = sum(marks) / (len(marks) + 2)
                if score >= min_score and sum(m >= personal.CONFIDENT for m in marks) >= min_seeds:
                    now[c, kind] = score
        grown, passed = len(now) > len(passed), now
        if not grown:
            break
        off = defaultdict(float)
        for (c, kind), score in now.items():
            for v, s in by[c]:
                if s < 0:
                    off[v, kind] += math.log1p(-0.9 * score)
        promoted = {k: 1 - math.exp(x) for k, x in off.items()}
    best = {}
    for (c, kind), score in sorted(passed.items(), key=lambda x: (x[1], -x[0][1])):
        best[c] = (kind, round(score, 9))
    return best


def test_rounds_equal_plain_loops(spark):
    rng = random.Random(11)
    seeds = {f"s{i}": i % 4 for i in range(40)}
    cands = []
    for c in range(30):
        for _ in range(rng.randrange(3, 25)):
            if rng.random() < 0.75:
                v = rng.choice([s for s in seeds if seeds[s] == c % 4 or rng.random() < 0.05])
            else:
                v = f"{rng.randrange(60):06d}" if rng.random() < 0.8 else f"x{rng.randrange(9)}"
            cands.append((f"c{c}", v, seeds.get(v, -1)))
    # contexts whose values only learnt ones support
    cands += [(f"d{k}", f"{v:06d}", -1) for k in range(2) for v in range(60)]
    df = spark.createDataFrame(cands, "context string, value string, seed int")
    for rounds in (1, 2, 10):
        got = {r.context: (r.kind, round(r.score, 9)) for r in personal.learnt_contexts(df, rounds, 0.5, 3).collect()}
        assert got == _plain(cands, rounds, 0.5, 3) and got
    assert personal.learnt_contexts(df.where("false"), 3, 0.5, 3).count() == 0


def test_learnt_values_carry_contexts(spark):
    """Values learnt behind 'mail' and behind 'write to' support 'user id', which no seed follows."""
    mail = [f"user{i}@site.org" for i in range(12)]
    plain = [f"acct{i}00{i}7{i}" for i in range(10, 22)]
    texts = [f"mail: {m} end" for m in mail] + [f"please write to {m} end" for m in mail]
    texts += [f"mail: {p} end, write to {p} now" for p in plain[:6]]
    texts += [f"the userid {p} end" for p in plain]
    texts += ["order no 1234567 went out", "order no 7654321 went out", "", None, "mail: 12 end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in personal.personal_data(docs).collect()}
    assert len(rows) == len(texts)
    at = 24
    assert all(rows[i].n_learnt == 0 and rows[i].n_email == 1 for i in range(24))
    assert all(rows[at + k].n_learnt == 2 and rows[at + k].n_email == 0 for k in range(6))
    first, spread = personal.personal_data(docs, rounds=1), rows
    assert {r.doc_id for r in first.where("n_learnt > 0").collect()} == set(range(24, 30))
    got = [i for i, r in spread.items() if r.n_learnt]
    assert set(range(24, 30)) <= set(got) and not {len(texts) - k for k in range(1, 6)} & set(got)


def test_contexts_of_lists_and_short_texts(spark):
    docs = spark.createDataFrame(
        [(1, "ids 12345678, 87654321"), (2, "Tel 12345678"), (3, "12345678"), (4, "a  (B7)\t-- 12345678"),
         (5, "w" * 300 + " 12345678")], "doc_id long, text string")
    rows = {r.doc_id: [list(c.contexts) for c in r.cands] for r in personal.scan(docs).collect()}
    assert rows[1] == [["ids"], ["#,"]] and rows[2] == [["tel"]] and rows[3] == []
    assert rows[4][-1] == ["#)"] and rows[5] == [["w" * 300]]
