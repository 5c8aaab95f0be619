import numpy as np
import pytest

from lakeshift.llm import chat as c


@pytest.mark.parametrize("line, marker, rest", [("User: hi", 1, "hi"), ("### Assistant", 2, ""), ("[system] x", 3, "x"), ("Q: why?", 1, "why?"), ("a house: red", 0, "a house: red"), ("AI: yes", 2, "yes"), ("**Human:** x", 1, "x"), ("usual: x", 0, "usual: x"), ("", 0, "")])
def test_markers(line, marker, rest):
    seen, cut = c.observed(line, False, False)
    assert (seen[0], line[cut:]) == (marker, rest)


def model():
    counts = [("start", 0, 0, 9), ("start", 0, 2, 3), ("move", 0, 1, 20), ("move", 1, 0, 20), ("move", 2, 0, 5), ("line", 0, 0, 20), ("line", 0, 1, 20), ("line", 1, 0, 20), ("line", 1, 1, 60), ("line", 2, 0, 5)]
    counts += [("f0", 0, 1, 18), ("f0", 0, 0, 2), ("f0", 2, 2, 18), ("f0", 2, 0, 2), ("f0", 4, 3, 5), ("f0", 1, 0, 30), ("f0", 3, 0, 60), ("f0", 5, 0, 9), ("f2", 0, 1, 9), ("f2", 2, 0, 20)]
    return c.Model(counts)


def brute(m, seen):
    from itertools import product

    best = None
    for path in product(range(c.STATES), repeat=len(seen)):
        score = m.start[path[0]] + sum(m.step[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(m.emission(x)[s] for x, s in zip(seen, path, strict=True))
        if best is None or score > best[0] + 1e-9:
            best = (score, path)
    return best


def test_viterbi_is_the_best_path():
    m, rng = model(), np.random.default_rng(1)
    for n in (1, 3, 5):
        seen = [tuple(int(rng.integers(k)) for k in c.SIZES) for _ in range(n)]
        score, _ = brute(m, seen)
        path = m.path(seen, None, None)
        got = m.start[path[0]] + sum(m.step[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(m.emission(x)[s] for x, s in zip(seen, path, strict=True))
        assert abs(got - score) < 1e-9 and abs(m.reach(seen, True)[0].max() - score) < 1e-9


def whole_run(m, rows):
    """Each conversation's turns by one Viterbi run over its lines: (conv, turn, line, role, n_lines, text, marker)."""
    out = []
    for conv in sorted({r.conv for r in rows}):
        own = sorted((r for r in rows if r.conv == conv), key=lambda r: (r.seq, r.tie))
        seen, lines = c.seen_in([{"seq": r.seq, "raw": r.raw, "first": True, "blank": False} for r in own])
        states = m.path(seen, None, None)
        starts = [k for k, x in enumerate(states) if x % 2 == 0 or k == 0]
        for a, b in zip(starts, [*starts[1:], len(states)], strict=True):
            text, marker = c.turn_of(lines[a:b], states[a], seen[a][0], False)
            out.append((conv, lines[a][0], lines[a][1], c.ROLES[states[a] // 2], b - a, text, marker))
    return sorted(out)


def joined(turns):
    """Rows of parse() with those that continue joined to the ones before."""
    out = []
    for r in sorted(turns, key=lambda r: (r.conv_id, r.turn, r.line)):
        body = r.text if r.continues else r.text.split("\n", 1)[1]
        if r.continues and out and out[-1][0] == r.conv_id:
            k = out[-1]
            out[-1] = (*k[:4], k[4] + r.n_lines, k[5] + body, k[6])
        else:
            out.append((r.conv_id, r.turn, r.line, r.role, r.n_lines, body, r.marker))
    ended = [(*k[:5], k[5].removesuffix("<|im_end|>").rstrip("\n"), k[6]) for k in out]
    assert all(k[5].endswith("<|im_end|>") and k[5].count("<|im_end|>") == 1 for k in out)
    return sorted(ended)


def talks(spark):
    rng = np.random.default_rng(4)
    rows = []
    for conv in range(15):  # all five styles
        for t in range(int(rng.integers(5, 40))):
            lines = [str(rng.choice(["text of this", "Note: bring an umbrella", "Answer: 42", "Q: what is it", "", "and more?", "  "])) for _ in range(int(rng.integers(1, 4)))]
            rows.append((conv, t, ("user", "assistant")[t % 2] if t else str(rng.choice(["user", "system"])), "\n".join(lines)))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_stretches_give_the_same_as_one_run(spark):
    """Brute force for the whole query: one run for each conversation; nothing of the transcripts is lost."""
    conv = talks(spark)
    rows = c.transcripts(conv)
    m = c.fit(rows)
    ordered = c.bounded(rows).collect()
    want = whole_run(m, ordered)
    for stretch in (3, 1000):
        got = joined(c.parse(c.transcripts(conv, stretch).drop("role"), m, stretch).collect())
        assert got == want
    assert {style for style in (x.conv for x in ordered)} == set(range(15))
    a, b = (np.concatenate([x.ravel() for x in (k.start, k.step, *k.see)]) for k in (c.fit(c.transcripts(conv, 3), 3), m))
    assert np.allclose(np.nan_to_num(a, neginf=-99), np.nan_to_num(b, neginf=-99))
    # the transcript is its turns' markers and texts, and blank lines at their ends
    for k in sorted({r.conv for r in ordered}):
        raw = "\n".join(r.raw or "" for r in sorted((r for r in ordered if r.conv == k), key=lambda r: (r.seq, r.tie)))
        lines = []
        for _, _, _, _, n, text, marker in sorted(x for x in want if x[0] == k):
            own = (marker + text).split("\n")
            lines += own + [""] * (n - len(own))
        assert "\n".join(lines) == raw


def test_markers_stay_where_a_turn_goes_on():
    lines = [(0, 0, "User: Hello there", 6), (0, 1, "Note: bring an umbrella", 6), (0, 2, "Answer: 42", 8)]
    assert c.turn_of(lines, 0, 1, False) == ("Hello there\nNote: bring an umbrella\nAnswer: 42", "User: ")
    assert c.turn_of(lines, 2, 1, False)[1] == "" and c.turn_of(lines, 1, 1, False)[0].startswith("User: ")


def test_many_lines_of_one_turn(spark):
    """Nine tenths of the lines have no turn number: they are dealt to stretches by their hash."""
    rows = [(1, None, "user", f"line {k} of them all") for k in range(900)] + [(1, t, "assistant", f"turn {t}") for t in range(100)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    x = c.bounded(c.transcripts(conv), most=50)
    assert x.groupBy("stretch").count().agg({"count": "max"}).first()[0] < 150
    m = c.fit(c.transcripts(conv))
    got = c.parse(c.transcripts(conv).drop("role"), m, most=50).collect()
    assert sum(r.n_lines for r in got) == sum(r.n_lines for r in c.parse(c.transcripts(conv).drop("role"), m).collect()) >= 1000


def test_roles_are_recovered(spark):
    sf = "/root/testdata/sf0.01"
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    got = {(r.conv_id, r.turn): r.role for r in c.op10_chat(spark, sf).where("line = 0").collect()}
    want = {(r.conv_id, r.turn): r.role for r in conv.collect()}
    assert np.mean([got.get(k) == v for k, v in want.items()]) > 0.9


def test_text_survives(spark):
    rows = [(1, 0, "user", "What is it?\nTell me."), (1, 1, "assistant", "It is so.\n\nIndeed."), (1, 2, "user", "Thanks")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = c.transcripts(conv)
    from pyspark.sql import functions as F

    marked = lines.withColumn("raw", F.concat(F.when(F.col("role") == "user", "User: ").otherwise("Assistant: "), F.element_at(F.array(*[F.lit(r[3]) for r in rows]), F.col("seq").cast("int") + 1)))
    got = [r.text for r in c.parse(marked.drop("role"), c.fit(marked)).orderBy("turn", "line").collect()]
    assert got == [f"<|im_start|>{r[2]}\n{r[3]}<|im_end|>" for r in rows]


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, 0, "tool", "a"), (1, 0, "tool", "a"), (1, 1, "user", ""), (2, 5, "assistant", "z\n" * 5000), (3, -4, "user", "Q: x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS conv", "1 AS stretch", "2 AS seq")
    m = c.fit(c.transcripts(conv))
    got = c.parse(c.transcripts(conv).drop("role"), m).collect()
    lines = {k: sum(r.n_lines for r in got if r.conv_id == k) for k in (None, 1, 2, 3)}
    assert {r.conv_id for r in got} == set(lines) and lines[None] >= 1 and lines[1] >= 3 and lines[2] >= 5001 and lines[3] >= 1
    assert sum(r.text.count("\nz") for r in got) == 5000
    empty = conv.limit(0)
    assert c.parse(c.transcripts(empty), m).count() == 0 and c.parse(c.transcripts(conv).drop("role"), c.fit(c.transcripts(empty))).count() > 0
