"""Secret scan: fixed patterns, and character Markov models for what has none.

Two first-order Markov models over characters, one of random strings and one
of ordinary identifiers, are trained from labelled samples. A part of a candidate
(a long run of identifier characters) is a secret when the random model makes it
more likely than the ordinary one by more than ``PRIOR`` (as a natural logarithm):
secrets are rare among long identifiers, so the ratio must outweigh that. The parts
are the best-scoring ones of the run, so a name joined to a key doesn't count against
it; a part ends where the ratio has fallen by ``PRIOR`` from its highest. It is widened
to the next '=', '/' or '_' (or end of the run) on both sides, and has ``LEAST``
characters or more then.

All of it is SQL functions over the text: no shuffle, no Python on executors.
The models are one table of character pairs, of fixed size (68 x 68), which
stands in the query as a literal.

Results: a null or empty text has no spans; spans are in code points, end
exclusive. Base spans stay as they are; a span found by the models is added if
it overlaps no base span. Repeated rows and ids give a row each; other columns
are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.llm.spans import match_places, quoted

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
WIDTH = len(ALPHABET) + 1
#: Least length of a run, and of a part of it that is a secret.
LEAST = 16
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Odds against a secret among candidates, as a logarithm: one in a million.
PRIOR = math.log(1e6)
#: Documents whose words are the samples of ordinary identifiers, at most.
SAMPLE_DOCUMENTS = 500

# Fixed patterns and least lengths. Runs of a class with a least length are the runs that pass.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Characters of the value that an assignment needs.
ASSIGN_LEAST = 6


def labelled_samples(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``sample, random`` from the documents of at most ``documents`` ids (by the order of a hash of the id).

    Ordinary (false): their words, as they are and joined to identifiers, paths and names with numbers.
    Random (true): digests of their texts, written in base 64 (plain, url-safe, alphanumeric) and in base 16."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # The ids are drawn first, so texts of others don't move: at most ``documents`` numbers are broadcast.
    ids = docs.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id")).limit(documents)
    some = docs.where("text is not null").join(F.broadcast(ids), "id")
    words = some.selectExpr("id", "regexp_extract_all(text, '[A-Za-z]+', 0) as w").where("size(w) > 0")
    pairs = "transform(sequence(1, size(w) - 1), i -> {})"
    number = "pmod(xxhash64(w[i - 1], i{}), cast(pow(10, 1 + pmod(i, 7)) as long))"
    a, b = number.format(""), number.format(", 1")
    # Each pair of words in one of these forms, by its place.
    forms = ["concat('/', w[i - 1], '/', w[i], '/')", "concat(w[i - 1], '-', w[i])", "concat(w[i - 1], '=', w[i])",
             f"concat(w[i - 1], {a})", f"concat(w[i - 1], '_', {a}, '-', {b})", f"concat({a}, '/', w[i], '=', {b})"]
    form = f"element_at(array({', '.join(forms)}), cast(pmod(i, {len(forms)}) as int) + 1)"
    joined = ("concat(w, case when size(w) < 2 then array() else concat("
              + pairs.format("concat(w[i - 1], '_', w[i])") + ", "
              + pairs.format("concat(lower(w[i - 1]), initcap(w[i]))") + ", " + pairs.format(form) + ") end)")
    ordinary = words.select(F.explode(F.expr(joined)).alias("sample"), F.lit(False).alias("random"))
    digest = some.select(F.explode(F.expr("sequence(1, 50)")).alias("i"), "id", "text").selectExpr(
        "sha2(concat(coalesce(id, 0), ' ', i, ' ', text), 256) as d")
    drawn = digest.select(F.explode(F.expr("array(base64(unhex(d)), translate(base64(unhex(reverse(d))), '+/=', ''), "
                                         "translate(base64(unhex(reverse(d))), '+/=', '-_'), d)"))
                          .alias("sample"), F.lit(True).alias("random"))
    return ordinary.union(drawn)


def train(samples: DataFrame) -> list[float]:
    """Logarithms of the ratio of transition likelihoods (random to ordinary), by pair of characters
    (``WIDTH * first + second``), from rows of ``sample, random``. Pairs are counted by Spark; only
    the table of counts, of fixed size, comes to the driver. Every pair counts once more than seen."""
    pairs = (samples.where("sample is not null and random is not null")
             .withColumn("at", F.explode(F.expr("sequence(1, greatest(length(sample) - 1, 1))")))
             .where("length(sample) > 1")
             .select("random", *[F.expr(f"instr({quoted(ALPHABET)}, substring(sample, at + {i}, 1))").alias(c)
                                 for i, c in enumerate("ab")]))
    counts = {r: [[1.0] * WIDTH for _ in range(WIDTH)] for r in (True, False)}
    for random, a, b, n in pairs.groupBy("random", "a", "b").count().collect():
        counts[random][a][b] += n
    return [math.log(counts[True][a][b] / sum(counts[True][a])) - math.log(counts[False][a][b] / sum(counts[False][a]))
            for a in range(WIDTH) for b in range(WIDTH)]


def random_parts(value: str, weights: list[float], prior: float) -> str:
    """SQL text: array of ``struct(lo, hi)`` (characters from 1, both inclusive) of the parts of the string ``value``
    (SQL text) whose log-likelihood ratio (random to ordinary) exceeds ``prior``, widened, in order, none overlapping."""
    table = f"cast(split('{','.join(f'{w:.6f}' for w in weights)}', ',') as array<double>)"
    none = "cast(array() as array<struct<lo:int,hi:int>>)"
    # The part so far: its sum, first character, highest sum and where that was.
    closed = f"if(acc.top > {prior}D, concat(acc.out, array(struct(acc.lo as lo, acc.hi as hi))), acc.out)"
    step = (f"aggregate(array(acc.sum + {table}[c[i - 2] * {WIDTH} + c[i - 1]]), acc, (acc, s) -> "
            f"case when s <= 0 or s <= acc.top - {prior}D then struct(0D as sum, i as lo, 0D as top, i as hi, {closed} as out) "
            "when s > acc.top then struct(s as sum, acc.lo as lo, s as top, i as hi, acc.out as out) "
            "else struct(s as sum, acc.lo as lo, acc.top as top, acc.hi as hi, acc.out as out) end)")
    found = (f"aggregate(array(transform(split({value}, ''), c -> instr({quoted(ALPHABET)}, c))), {none}, (o, c) -> "
             f"aggregate(sequence(2, greatest(size(c), 2)), struct(0D as sum, 1 as lo, 0D as top, 1 as hi, {none} as out), "
             f"(acc, i) -> {step}, acc -> {closed}))")
    wide = (f"transform({found}, p -> struct(p.lo - length(regexp_extract(substring({value}, 1, p.lo - 1), '[^=/_]*$', 0)) as lo, "
            f"p.hi + length(regexp_extract(substring({value}, p.hi + 1), '^[^=/_]*', 0)) as hi))")
    return (f"filter(aggregate({wide}, {none}, (o, p) -> if(size(o) > 0 and p.lo <= element_at(o, -1).hi, "
            "concat(slice(o, 1, size(o) - 1), array(struct(element_at(o, -1).lo as lo, greatest(p.hi, element_at(o, -1).hi) as hi))), "
            f"concat(o, array(p)))), p -> p.hi - p.lo + 1 >= {LEAST})")


def scan(docs: DataFrame, weights: list[float], prior: float = PRIOR, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, found``: the spans ``(start, rank, end, kind, value)`` of each text, by start and then
    kind (assign, access, hex, markov)."""
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = (f"concat(filter({match_places('text', ASSIGN, 'assign', 0, 2)}, x -> length(x.value) >= {ASSIGN_LEAST}), "
            f"{match_places('text', ACCESS, 'access', 1)}, {match_places('text', HEX, 'hex', 2)})")
    random = (f"flatten(transform({match_places('text', CANDIDATE, 'markov', 3)}, "
              f"x -> transform({random_parts('x.value', weights, prior)}, p -> struct(x.start + p.lo - 1 as start, x.rank as rank, "
              "x.start + p.hi as end, x.kind as kind, substring(x.value, p.lo, p.hi - p.lo + 1) as value))))")
    df = df.withColumn("base", F.expr(base)).withColumn("random", F.expr(random))
    free = "filter(random, x -> not exists(base, y -> y.start < x.end and x.start < y.end))"
    return df.select("doc_id", F.expr(f"array_sort(concat(base, {free}))").alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov`` of :func:`scan`'s result."""
    def joined(spans: str) -> str:
        return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"

    def count(kind: str) -> Column:
        return F.expr(f"cast(size(filter(found, x -> x.kind = '{kind}')) as long)").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.expr(f"sha2({joined('filter(found, x -> x.rank < 3)')}, 256)").alias("base_sha256"),
                        F.expr(joined("found")).alias("spans"), count("markov"))
