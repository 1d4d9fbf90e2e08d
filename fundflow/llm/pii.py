"""Personal data: each entity found is replaced by a keyed surrogate of its kind.

* *Detection*: one pattern with an alternative for each kind (e-mail address,
  IP addresses of both versions, bank account, card, social security and phone numbers, names
  behind a title), leftmost matches, no overlaps. Between them, words that are a name found
  in the same text (given name or surname, capitalised or in capitals) are mentions of it too.
  Names that never stand behind a title, and numbers written in other ways (``00 49 30 901820``), aren't found.
* *Canonical form*: what mentions of one entity have in common (digits without
  separators and country prefix; lower case; a name without its title). All
  mentions of an entity get the same surrogate, each in its own format.
* *Surrogate*: drawn by SHA-256 from the key, the kind and the canonical form.
  Digits stand for digits and letters for letters; a card that passes the Luhn
  check does so again, parts of an IP address stay below 256 and as long as they were,
  e-mail addresses go to the reserved ``example`` domain; names keep gender (by
  their title, or behind a title that has none by an ending in a), script (Latin or Cyrillic) and case.
* *Collision checks*: over the table of all distinct entities of the corpus, no two
  entities of a kind may have one surrogate, and no surrogate may be an entity
  of the corpus. Entities that collide (all but the first) are drawn anew, in
  rounds, until none does.

Only SQL functions are used. Documents without a mention pass through one
projection; only those with mentions are staged and joined with their
surrogates. An entity that very many documents mention is one row of the table,
and the join back can split its mentions.

Results: null and empty texts stay as they are; ``n_chars`` (where there is
one) is the new text's length; repeated rows stay repeated; other columns pass
through, but for one named ``n_replaced``, which is replaced; an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import staged
from fundflow.llm.spans import quoted

# Fixed patterns, in order of precedence.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "господин"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "госпожа"),
          "": ("Dr", "Prof", "Professor", "Doktor", "Docteur", "Доктор")}
TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t)))
WORD = r"\p{Lu}\p{L}+(?:-\p{Lu}\p{L}+)?"
HEX = "[0-9A-Fa-f]{1,4}"
#: A word, as bare mentions of names are looked for.
TOKEN = r"\p{L}[\p{L}0-9]*(?:-\p{L}[\p{L}0-9]*)*"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    # Eight groups, or two colons for some of them; with a digit, so that no other pair of colons is one.
    "ipv6": rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:{HEX}(?::{HEX}){{7}}|{HEX}(?::{HEX}){{0,6}}::(?:{HEX}(?::{HEX}){{0,6}})?"
            rf"|::{HEX}(?::{HEX}){{0,6}})(?![0-9A-Za-z:]|\.[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|-[0-9])"
             r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z+.-])(?:[0-9][ -]?){12,18}[0-9](?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}0-9])(?:{TITLE})\.?[ ]{WORD}(?:[ ]{WORD})?",
}
ANY = "|".join(KINDS.values())
#: What a text needs to hold any of them: cheap to look for.
HINT = rf"[@0-9]|(?:{TITLE})\.?[ ]\p{{Lu}}"
#: After so many draws that collide, a surrogate may be longer than what it stands for.
WIDEN = 8
MOST_DRAWS = 64
# Syllables of names, by script.
SYLLABLES = {"latin": "ba de fi go la mi no ra se ti va lo ne ru ka do", "cyrillic": "ба де фи го ла ми но ра се ти ва ло не ру ка до"}
ENDINGS = {("latin", "given", "m"): "n", ("latin", "given", "f"): "na", ("latin", "surname", "m"): "r",
           ("cyrillic", "given", "m"): "н", ("cyrillic", "given", "f"): "на",
           ("cyrillic", "surname", "m"): "ров", ("cyrillic", "surname", "f"): "рова"}


def _kind(mention: str) -> str:
    """SQL text: the kind of a mention."""
    return "case " + " ".join(f"when {mention} rlike {quoted('^(?:' + p + ')$')} then '{k}'" for k, p in KINDS.items()) + " end"


def _parts(mention: str) -> str:
    """SQL text: array of ``struct(kind, canonical, word)``: the entities in a mention. Names have a
    given name (of two words, the first) and a surname, which are entities each."""
    digits = f"regexp_replace({mention}, '[^0-9]', '')"
    national = f"case when length({digits}) > 10 then right({digits}, 10) else {digits} end"
    one = (f"case kind when 'email' then lower({mention}) when 'ip' then {mention} when 'ipv6' then lower({mention}) "
           f"when 'iban' then replace({mention}, ' ', '') when 'phone' then {national} else {digits} end")
    female, neutral = "|".join(TITLES["f"]), "|".join(TITLES[""])
    gender = (f"case when {mention} rlike {quoted(f'^(?:{female})' + '[. ]')} then 'f' "
              f"when {mention} rlike {quoted(f'^(?:{neutral})' + '[. ]')} and lower(w) rlike '[aа]$' then 'f' else 'm' end")
    words = f"slice(split({mention}, ' '), 2, 2)"
    script = "case when w rlike '\\\\p{IsCyrillic}' then 'cyrillic' else 'latin' end"
    # Latin surnames are the same for all genders.
    names = (f"transform({words}, (w, i) -> struct(concat(if(i = 0 and size({words}) > 1, 'given', 'surname'), ' ', "
             f"{script}, ' ', if(i + 1 = size({words}) and {script} = 'latin', 'm', {gender})) as kind, initcap(lower(w)) as canonical, w as word))")
    return f"case when kind = 'name' then {names} else array(struct(kind, {one} as canonical, {mention} as word)) end"


def _draw(key: str) -> str:
    """SQL text: 124 hex digits drawn for (key, kind, canonical, draw)."""
    one = "sha2(concat_ws('\\u001f', {}, kind, canonical, draw, '{}'), 256)"
    return f"concat({', '.join(one.format(quoted(key), x) for x in 'ab')})"


def _number(i: str) -> str:
    """SQL text: a number below 65,536 from the hex digits ``h`` for place ``i``."""
    return f"cast(conv(substring(h, 1 + pmod(({i}) * 4, 124), 4), 16, 10) as int)"


def _alike(value: str) -> str:
    """SQL text: a digit for each digit, a letter of the same case for each letter a-z."""
    c = f"substring({value}, i, 1)"
    n = _number("i")
    return (f"array_join(transform(sequence(1, greatest(length({value}), 1)), i -> case "
            f"when {c} rlike '[0-9]' then cast({n} % 10 as string) when {c} rlike '[a-z]' then char(97 + {n} % 26) "
            f"when {c} rlike '[A-Z]' then char(65 + {n} % 26) else {c} end), '')")


def _luhn(digits: str) -> str:
    """SQL text: the Luhn sum of a number, modulo 10."""
    d = f"cast(substring({digits}, length({digits}) + 1 - i, 1) as int)"
    return (f"pmod(aggregate(sequence(1, length({digits})), 0, (acc, i) -> acc + "
            f"case when i % 2 = 1 then {d} when {d} > 4 then {d} * 2 - 9 else {d} * 2 end), 10)")


def _surrogate() -> str:
    """SQL text: the canonical form of the surrogate for ``kind, canonical, draw, h``."""
    wide = f"draw >= {WIDEN}"
    extra = f"if({wide}, concat(char(97 + {_number('90')} % 26), char(97 + {_number('91')} % 26), cast(draw as string)), '')"
    local, domain = "substring_index(canonical, '@', 1)", "substring_index(canonical, '@', -1)"
    labels = f"split({domain}, '[.]')"
    email = (f"concat({_alike(local)}, {extra}, '@', array_join(concat(slice(split({_alike(domain)}, '[.]'), 1, "
             f"greatest(size({labels}) - 2, 0)), array('example', element_at({labels}, -1))), '.'))")
    octet = (f"case when {wide} then {_number('j + 40')} % 256 when length(o) = 1 then {_number('j + 40')} % 10 "
             f"when length(o) = 2 then 10 + {_number('j + 40')} % 90 else 100 + {_number('j + 40')} % 156 end")
    ip = f"array_join(transform(split(canonical, '[.]'), (o, j) -> cast({octet} as string)), '.')"
    ipv6 = (f"array_join(transform(sequence(1, length(canonical)), i -> if(substring(canonical, i, 1) = ':', ':', "
            f"lower(hex({_number('i')} % 16)))), '')")
    iban = f"concat(left(canonical, 2), substring({_alike('canonical')}, 3))"
    body = f"concat(left(canonical, 1), substring({_alike('left(canonical, length(canonical) - 1)')}, 2))"
    card = (f"case when {_luhn('canonical')} = 0 then element_at(transform(array({body}), b -> concat(b, cast(pmod(10 - "
            + _luhn("concat(b, '0')") + f", 10) as string))), 1) else concat(left(canonical, 1), substring({_alike('canonical')}, 2)) end")
    # Syllables; more of them from draw to draw, so there are always names left.
    names = []
    for (script, part, gender), ending in ENDINGS.items():
        many = f"{2 if part == 'given' else 3} + draw div 4"
        syllables = "array({})".format(", ".join(f"'{s}'" for s in SYLLABLES[script].split()))
        names.append(f"when kind = '{part} {script} {gender}' then concat(initcap(array_join(transform(sequence(1, {many}), "
                     f"i -> {syllables}[{_number('i')} % 16]), '')), '{ending}')")
    return (f"case when kind = 'email' then {email} when kind = 'ip' then {ip} when kind = 'ipv6' then {ipv6} when kind = 'iban' then {iban} "
            f"when kind = 'card' then {card} {' '.join(names)} else {_alike('canonical')} end")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct entities ``kind, canonical``; see the module's text."""
    def drawn(df: DataFrame) -> DataFrame:
        return df.withColumn("h", F.expr(_draw(key))).withColumn("surrogate", F.expr(_surrogate())).drop("h")

    table = staged(drawn(entities.select("kind", "canonical", F.lit(0).alias("draw"))), "surrogates")
    for _ in range(MOST_DRAWS):
        taken = entities.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("taken"))
        marked = (table.withColumn("place", F.expr("row_number() over (partition by kind, surrogate order by draw, canonical)"))
                  .join(taken, ["kind", "surrogate"], "left"))
        marked = marked.withColumn("again", F.expr("place > 1 or coalesce(taken, false)"))
        if not marked.where("again").limit(1).count():
            return table.drop("draw")
        kept = marked.where("not again").select("kind", "canonical", "draw", "surrogate")
        table = staged(kept.union(drawn(marked.where("again").select("kind", "canonical", F.expr("draw + 1").alias("draw")))),
                       "surrogates")
    raise RuntimeError(f"surrogates still collide after {MOST_DRAWS} draws")


def _written() -> str:
    """SQL text: the surrogate ``surrogate`` of a part, in the format of its ``word``."""
    digits = "length(regexp_replace(left(word, i - 1), '[^0-9]', ''))"
    # Places of the digits that stand for the canonical form: the last ones.
    first = "(length(regexp_replace(word, '[^0-9]', '')) - length(canonical))"
    number = (f"array_join(transform(sequence(1, length(word)), i -> case when substring(word, i, 1) rlike '[0-9]' and "
              f"{digits} >= {first} then substring(surrogate, {digits} - {first} + 1, 1) else substring(word, i, 1) end), '')")
    letters = "length(replace(left(word, i - 1), ' ', ''))"
    iban = (f"array_join(transform(sequence(1, length(word)), i -> if(substring(word, i, 1) = ' ', ' ', "
            f"substring(surrogate, {letters} + 1, 1))), '')")
    return (f"case when part in ('phone', 'card', 'ssn') then {number} when part = 'iban' then {iban} "
            "when part <> 'ip' and word = upper(word) and word <> lower(word) then upper(surrogate) else surrogate end")


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """``mention, replacement, names`` for distinct mentions ``mention``; ``names``: of the names in it, the
    canonical form, the surrogate, and whether it is a surname (first) or a given name."""
    parts = staged(mentions.withColumn("kind", F.expr(_kind("mention"))).withColumn("parts", F.expr(_parts("mention")))
                   .select("mention", F.posexplode("parts").alias("place", "p"))
                   .selectExpr("mention", "place", "p.kind as part", "p.canonical as canonical", "p.word as word"), "mentions")
    table = surrogates(staged(parts.selectExpr("part as kind", "canonical").distinct(), "entities"), key)
    named = parts.join(table.withColumnRenamed("kind", "part"), ["part", "canonical"]).withColumn("written", F.expr(_written()))
    title = "if(element_at(words, 1).part rlike ' ', concat(substring_index(mention, ' ', 1), ' '), '')"
    # At most two parts a mention.
    return (named.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("place", "written", "part", "canonical", "surrogate"))).alias("words"))
            .selectExpr("mention", f"concat({title}, array_join(transform(words, w -> w.written), ' ')) as replacement",
                        "transform(filter(words, w -> w.part rlike ' '), w -> struct(w.canonical as canonical, "
                        "w.part like 'given%' as given, w.surrogate as surrogate)) as names"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The documents with surrogates in their texts, and ``n_replaced`` behind."""
    own = [c for c in docs.columns if c != "n_replaced"]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    text = F.col(f"`{text_col}`")
    hit = F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))
    found = docs.where(hit).select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), text.alias("t"))
    found = staged(found.withColumn("mentions", F.expr(f"regexp_extract_all(t, {quoted(ANY)}, 0)"))
                   .withColumn("id", F.monotonically_increasing_id()).drop("t"), "found")
    each = found.select("id", F.explode(F.array_distinct("mentions")).alias("mention"))
    table = replacements(each.select("mention").distinct(), key)
    joined = staged(each.join(table, "mention"), "mentions")
    maps = joined.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("mention", "replacement"))).alias("by"))
    # A word that is a surname and a given name in one text stands for the surname.
    names = (joined.select("id", F.explode("names").alias("n")).groupBy("id", "n.canonical")
             .agg(F.expr("min(struct(n.given, n.surrogate))").alias("m")).groupBy("id")
             .agg(F.map_from_entries(F.collect_list(F.struct("canonical", "m.surrogate"))).alias("names")))
    # What stands between the mentions, as words and what is between those; and the words that are names.
    token = quoted(TOKEN)
    gaps = (f"transform(split(row.`{text_col}`, {quoted(ANY)}, -1), g -> struct(split(g, {token}, -1) as between, "
            f"transform(regexp_extract_all(g, {token}, 0), w -> struct(w as word, if(w rlike '^\\\\p{{Lu}}' and "
            "(w = initcap(lower(w)) or w = upper(w) or w rlike '-'), names[initcap(lower(w))], null) as name)) as words))")
    word = "coalesce(if(w.word = upper(w.word) and length(w.word) > 1, upper(w.name), w.name), w.word)"
    gap = f"array_join(zip_with(g.between, transform(g.words, w -> {word}), (b, w) -> concat(b, coalesce(w, ''))), '')"
    plain = f"split(row.`{text_col}`, {quoted(ANY)}, -1)"
    new = F.expr(f"array_join(zip_with(coalesce(transform(gaps, g -> {gap}), {plain}), transform(mentions, m -> by[m]), "
                 "(g, m) -> concat(g, coalesce(m, ''))), '')")
    bare = "aggregate(gaps, 0, (n, g) -> n + size(filter(g.words, w -> w.name is not null)))"
    done = (found.join(maps, "id").join(names, "id", "left")
            .withColumn("gaps", F.expr(f"case when names is not null then {gaps} end"))
            .withColumn("new", new).withColumn("n", F.expr(f"size(mentions) + coalesce({bare}, 0)")))
    columns = []
    for c in own:
        value = F.col(f"row.`{c}`")
        if c == text_col:
            value = F.col("new")
        elif c == "n_chars":
            value = F.length("new").cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return (done.select(*columns, F.col("n").alias("n_replaced"))
            .union(docs.where(~hit).withColumn("n_replaced", F.lit(0))))
