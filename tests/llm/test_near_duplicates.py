"""Near duplicates and components against brute force."""

import glob
import random

import pytest

import corpus_pipeline
from fundflow.llm import bottomk, components
from fundflow.session import checkpoint_root, local_path

SCHEMA = "doc_id long, text string, component_id string, sketch int"


def brute(rows, words, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                i_, j_ = root(i), root(j)
                parent[max(i_, j_)] = min(i_, j_)
    return [(i, len(x), None if i is None else root(i), i is None or root(i) == i) for i, x in sets]


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.5:
            words = out[rng.randrange(len(out))][1].split()
            for _ in range(rng.randrange(6)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.randrange(0, 90))
            if kind > 0.9:
                words += passage
        out.append((i, " ".join(words)))
    # A chain, each link similar to the next, its ends not.
    words = rng.choices(vocabulary, k=100)
    for j in range(8):
        words = words[:]
        words[j * 9] = "new"
        out.append((n + j, " ".join(words)))
    out += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "Single"), (1004, "sINGLE"), (1005, "A b"), (1006, "a\x0bB\x0c"),
            (None, "a b"), (1007, "É b"), (1008, "é b"), (5, out[5][1])]
    return out


@pytest.mark.parametrize("words,seed", [(2, 1), (2, 2), (5, 3)])
def test_components_as_brute_force(spark, words, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = bottomk.near_duplicates(df, words=words, percent=80)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows, words, 80)))


def test_large_group_of_near_copies(spark):
    """A group far larger than a sketch, whose members aren't all linked with each other."""
    rng = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(250):
        words = base[:]
        for _ in range(rng.randrange(1, 13)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows, 2, 80))
    assert len({r[2] for r in want}) > 5
    assert sorted(map(tuple, bottomk.near_duplicates(df, words=2).collect())) == want
    # Groups in many blocks; then all as pairs of lists.
    assert sorted(map(tuple, bottomk.near_duplicates(df, words=2, small=4, block=16).collect())) == want
    assert sorted(map(tuple, bottomk.near_duplicates(df, words=2, small=10_000).collect())) == want


def repeated():
    a, b, c = ([f"{p}{i}" for i in range(100)] for p in "abc")
    near = b[:]
    near[50] = "new"
    return [(3, " ".join(near)), (5, " ".join(a)), (5, " ".join(b)), (5, " ".join(b)), (8, " ".join(c)), (8, " ".join(c)),
            (9, ""), (9, ""), (9, " "), (None, " ".join(c)), (None, " ".join(c))]


def test_repeated_ids_with_other_texts(spark):
    """A text alone under its id stays, whatever other text has that id."""
    rows = repeated()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"small": 1, "block": 1}):
        got = bottomk.near_duplicates(df, **options).select("doc_id", "component_id", "kept").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
            (3, 3, True), (5, 5, True), (5, 3, False), (5, 3, False), (8, 8, True), (8, 8, True),
            (9, 9, True), (9, 9, True), (9, 9, True), (None, None, True), (None, None, True)]))


def test_pipeline_keeps_one_row_of_each_group(spark):
    rows = [(i, t, "en", f"s{n}", len(t)) for n, (i, t) in enumerate(repeated())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == corpus_pipeline.COLUMNS
    assert sorted(r.source for r in got.collect()) == sorted(["s0", "s1", "s4", "s6", "s8", "s9", "s10"])


def test_common_shingles_offer_few_pairs(spark, monkeypatch):
    """Documents of a few words have many shingles in common, two by two: that alone makes no pairs or groups."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, [1 / (j + 3) for j in range(60)], k=150))) for i in range(400)]
    for i in range(0, 400, 40):
        edited = rows[i][1].split()
        edited[70] = "new"
        rows.append((1000 + i, " ".join(edited)))
    pairs, members = [], [0]
    estimated, compared = bottomk._estimated, bottomk._compared
    monkeypatch.setattr(bottomk, "_estimated", lambda found, *a: pairs.append(found.count()) or estimated(found, *a))
    monkeypatch.setattr(bottomk, "_compared", lambda groups, *a: members.append(groups.count()) or compared(groups, *a))
    got = bottomk.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 2, 80))
    assert pairs[0] < 1000 and sum(members) < 1000, (pairs, members)


def test_small_sets_are_not_missed(spark):
    """Sets of up to 64 shingles that are just similar enough, whatever the order of their hashes."""
    rows = []
    for size in range(4, 65):
        for j in range(3):
            a = [f"s{size}.{j}.{x}" for x in range(size)]
            b, c = a[size // 5:], a + [f"t{size}.{j}.{x}" for x in range(min(size // 4, 64 - size))]
            rows += [(len(rows) + x, " ".join(t)) for x, t in enumerate((a, b, c))]
    got = bottomk.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1)
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(i, i - i % 3) for i, _ in rows}


def test_written_tables_go(spark):
    rows = [r for r in corpus(4, 40) if r[0] is not None]
    folders = lambda: set(glob.glob(f"{local_path(checkpoint_root(spark))}/fundflow/llm-*"))
    before = folders()
    got = bottomk.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2, small=1, block=4)
    assert sorted(f.rsplit("llm-", 1)[1].rsplit("-", 1)[0] for f in folders() - before) == ["classes", "links", "sets"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 2, 80))


def test_empty(spark):
    assert bottomk.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    links += [(7, 7), (None, 3), (2, None)] + [(500, 500 + i) for i in range(50)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(i, root(i)) for i in list(parent) if root(i) != i}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _tasks(spark, run):
    """Tasks that ``run`` starts, with as many partitions to every shuffle as are set (8)."""
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sc.setJobGroup("counted", "tasks of a test")
    try:
        run()
        stages = {s for j in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(j).stageIds}
        return sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_few_tasks_a_round(spark):
    # The driver keeps account of every task: stars are known as such after one round of few shuffles.
    stars = spark.createDataFrame([(i % 5, 100 + i) for i in range(200)], "a long, b long").repartition(2)
    assert _tasks(spark, lambda: components.components(stars).collect()) <= 90


def test_one_of_each_has_few_shuffles(spark):
    df = spark.createDataFrame(repeated(), "doc_id long, text string")
    plan = bottomk.one_of_each(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 10, plan.count("Exchange")


def test_one_of_each_without_words_or_id(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y z"), (2, "A b c d e f"), (3, ""), (3, ""), (3, None), (3, " "),
            (4, ""), (None, "a b c d e f"), (None, "a b c d e f"), (5, "x y z")]
    got = sorted(((r.doc_id, r.text) for r in bottomk.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()),
                 key=str)
    # The smallest of "" and null (one text, ""), 3's blank is another text.
    assert got == sorted([(1, "a b c d e f"), (1, "x y z"), (3, None), (3, " "), (4, ""), (None, "a b c d e f"),
                          (None, "a b c d e f")], key=str)
