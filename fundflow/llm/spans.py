"""Places of pattern matches, with SQL functions alone."""

from __future__ import annotations


def quoted(pattern: str) -> str:
    """A regular expression as a SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def match_places(text: str, pattern: str, kind: str, rank: int, group: int = 0) -> str:
    """SQL text: array of ``struct(start, rank, end, kind, value)`` of the leftmost matches that
    don't overlap, in code points (``end`` exclusive). ``value`` is the match, or its ``group``.

    Splitting a text at the matches leaves what stands between them, so a match starts where the
    lengths of all before it end. Only texts that have a match are split.
    """
    p = quoted(pattern)
    empty = "cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string>>)"
    step = (f"(acc, m) -> struct(acc.at + length(m.gap) + length(m.hit) as at, concat(acc.out, array(struct("
            f"acc.at + length(m.gap) as start, {rank} as rank, acc.at + length(m.gap) + length(m.hit) as end, "
            f"'{kind}' as kind, m.value as value))) as out)")
    return (f"case when {text} rlike {p} then aggregate(transform(array(struct("
            f"regexp_extract_all({text}, {p}, 0) as h, split({text}, {p}, -1) as g, "
            f"regexp_extract_all({text}, {p}, {group}) as v)), x -> "
            f"transform(sequence(1, size(x.h)), i -> struct(x.h[i - 1] as hit, x.g[i - 1] as gap, x.v[i - 1] as value)))[0], "
            f"struct(0 as at, {empty} as out), {step}, acc -> acc.out) else {empty} end")
