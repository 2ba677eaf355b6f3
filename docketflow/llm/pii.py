"""Replaces personal data and secrets by surrogates of the same kind, in SQL expressions only.

Mentions are found by one pattern: mail addresses, telephone and card numbers, IP
addresses, IBANs, social security numbers, access keys, secrets behind a label, and people
behind a title. A card number must have a valid check digit, so other long numbers stay.
In a text that names a person with a title, the bare name is a mention too.

A mention has a normal form, so that one entity written in several ways is one entity, in
every document (coreference). Each distinct normal form gets a surrogate from a keyed hash,
of the same kind, length and classes of characters: card numbers keep issuer and a valid
check digit, telephone numbers their country code, addresses a valid range, people their
title, script and gender. Surrogates that two entities share, or that are an entity of the
corpus themselves, are drawn again (distinctness). Who still has none after some draws gets
one of the free values of its class by rank, and where none is free, draws go on in a wider
class: names, mailboxes and numbers get longer, private addresses leave their range. The
surrogate is then poured into the format in which the mention is written.

Only distinct mentions are moved and joined, by the digest of the text they are in; texts
that hold none of the signs of a mention are passed on as they are read.

Defined results: a null text stays null, an empty one empty, with 0 replaced. Equal texts
get equal results, repeated rows stay rows of their own. Other columns, whatever their
names, pass through; `n_replaced` is replaced if there is one. A table without rows gives
none. Surrogates depend on the key and on which entities the table holds.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import stored

# Titles by gender, in the languages and scripts served.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Signora", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof", "Professor"],
}
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.?"
# Letters of a name, also behind an apostrophe that begins no ending; an initial or a name.
_LETTERS = r"(?:(?:['’](?=\p{Lu}\p{L}))?\p{L})++"
_NAME = rf"(?:\p{{Lu}}\.|\p{{Lu}}{_LETTERS}(?:-\p{{Lu}}{_LETTERS})*+)"
_TITLED = rf"{_TITLE}(?!\p{{L}})(?:\s+{_TITLE}(?!\p{{L}}))*+\s++"

# A label in any case, maybe quoted as in JSON, up to the sign behind it.
_LABEL = r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)\\?["']?\s{0,8}(?::=|=>|[=:])"""
# The patterns of mentions, in the order in which a mention's kind is told.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "mail": r"(?<![\w.%+-])[A-Za-z0-9](?:[\w.%+-]{0,62}[\w%+-])?@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w+])\d(?:[ -]?\d){12,18}(?![\w])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w+.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "key": r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)",
    "hash": r"(?<!\w)(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})(?!\w)",
    # The one character before is looked at first, as labels are costly to look for.
    "secret": rf"""(?<=[=:>\s"'])(?<={_LABEL}\s{{0,8}}\\?["']?)(?=[_+/.~-]*+[A-Za-z0-9])[A-Za-z0-9_+/.~-]++(?:={{1,2}}(?![\w=]))?+(?=["'\s,;<&%$#*)!\\\]}}]|$)""",
    # Names go on over one line's end, not over a blank line.
    "person": rf"(?<![\p{{L}}]){_TITLED}{_NAME}(?:(?!\s*+(?<=\n\s{{0,8}}\n\s{{0,8}}))\s++{_NAME})*+",
}
ANY = "(?:" + "|".join(PATTERNS.values()) + ")"
#: Signs without which there is no mention; much cheaper to look for.
SIGNS = rf"[0-9@]|(?<![\p{{L}}]){_TITLE}\s|{_LABEL}"

# Syllables of surrogate names, and their endings by gender.
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "hal", "jo", "ka", "len", "mar", "no", "or", "pe", "ri", "sal", "tor", "va"],
    "cyrillic": ["ба", "ве", "го", "да", "зи", "ка", "ле", "ми", "но", "ра", "се", "та", "фи", "хо", "юл", "яр"],
    "greek": ["βα", "γε", "δι", "ζω", "θα", "κα", "λε", "μι", "νο", "πα", "ρο", "σε", "τα", "φι", "χα", "ψι"],
}
ENDINGS = {
    "latin": {"m": "ren", "f": "lia", "n": "is"},
    "cyrillic": {"m": "лав", "f": "ина", "n": "ко"},
    "greek": {"m": "νος", "f": "νια", "n": "ις"},
}
#: Draws before free values are dealt out; values of a class that many entities could not fill.
_DRAWS, _MANY = 8, 1 << 31
#: Values that one row of an enumeration stands for.
_RUN = 1 << 12


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _check(digits: str) -> str:
    """SQL: the sum by which card numbers are checked, over text of digits."""
    return (
        f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> case when i % 2 = 0 then int(c) "
        f"else int(c) * 2 - if(int(c) > 4, 9, 0) end), 0, (a, x) -> a + x)"
    )


def _kind(mention: str) -> str:
    """SQL: the kind of a mention, null if it only looks like one."""
    cases = []
    for kind, pattern in PATTERNS.items():
        if kind == "secret":
            continue
        test = f"{mention} rlike {_quoted('^(?:' + pattern + ')$')}"
        if kind == "card":
            digits = f"regexp_replace({mention}, '[ -]', '')"
            cases.append(f"when {test} then if({_check(digits)} % 10 = 0, 'card', null)")
        else:
            cases.append(f"when {test} then '{kind}'")
    return "case " + " ".join(cases) + " else 'secret' end"


def _random(at: str) -> str:
    """SQL: a number from the keyed hash of an entity and a draw."""
    return f"cast(conv(substring(sha2(concat_ws('|', secret_key, kind, norm, draw, {at}), 256), 1, 8), 16, 10) as bigint)"


def _like(c: str, at: str) -> str:
    """SQL: a character of the same class."""
    pick = lambda signs: f"substring('{signs}', cast({_random(at)} % {len(signs)} as int) + 1, 1)"
    return (
        f"case when {c} between '0' and '9' then {pick('0123456789')} "
        f"when {c} between 'a' and 'f' and hexadecimal then {pick('abcdef')} "
        f"when {c} between 'A' and 'F' and hexadecimal then {pick('ABCDEF')} "
        f"when {c} between 'a' and 'z' then {pick('abcdefghijklmnopqrstuvwxyz')} "
        f"when {c} between 'A' and 'Z' then {pick('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} else {c} end"
    )


def _spelt(text: str, keep: str = "0", offset: str = "0") -> str:
    """SQL: text with all characters but the first `keep` replaced by others of their class."""
    return f"array_join(transform(split({text}, ''), (c, i) -> if(i < {keep}, c, {_like('c', f'i + {offset}')})), '')"


_PRIVATE = "case when shape like '10.%' then 1 when shape like '192.168.%' then 2 when shape rlike '^172[.](1[6-9]|2[0-9]|3[01])[.]' then 2 else 0 end"
#: SQL: an entity's normal form, longer or of another range where its class was full.
_SHAPE = f"""case when width = 0 or kind like 'name%' then norm
    when kind = 'ip' then if(width = 1 and {_PRIVATE.replace('shape', 'norm')} = 2, '10.1.1.1', '1.1.1.1')
    when kind = 'mail' then concat(substring_index(norm, '@', 1), repeat('a', width), '@', substring_index(norm, '@', -1))
    else concat(norm, repeat('0', width)) end"""


def _spelling(text: str, keep: str) -> str:
    """SQL: for each character of text, those of its class; itself for the first `keep`."""
    return (
        f"transform(split({text}, ''), (c, i) -> case when i < {keep} then c when c between '0' and '9' then '0123456789' "
        "when c between 'a' and 'f' and hexadecimal then 'abcdef' when c between 'A' and 'F' and hexadecimal then 'ABCDEF' "
        "when c between 'a' and 'z' then 'abcdefghijklmnopqrstuvwxyz' when c between 'A' and 'Z' then 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' else c end)"
    )


def _class() -> str:
    """SQL: the characters in turn that surrogates of an entity's class have; of an address, the octets kept."""
    keep = "case kind when 'card' then 1 when 'phone' then country when 'iban' then 2 when 'key' then 4 else 0 end"
    text = "case kind when 'card' then substring(shape, 1, length(shape) - 1) when 'mail' then substring_index(shape, '@', 1) else shape end"
    return f"case when kind = 'ip' then slice(split(shape, '[.]'), 1, {_PRIVATE}) else {_spelling(text, keep)} end"


def _numbered() -> str:
    """SQL: the value of a class by its number, from columns kind, class, tail, number."""
    digits = (
        "aggregate(class, named_struct('n', number, 'out', ''), (s, x) -> named_struct('n', s.n div length(x), "
        "'out', concat(s.out, substring(x, cast(s.n % length(x) as int) + 1, 1))), s -> s.out)"
    )
    octets = "array_join(concat(class, transform(sequence(size(class) + 1, 4), i -> cast(number div cast(pow(254, i - size(class) - 1) as bigint) % 254 + 1 as string))), '.')"
    check = f"cast((10 - {_check(f"concat({digits}, '0')")} % 10) % 10 as string)"
    return f"case when kind = 'ip' then {octets} when kind = 'card' then concat({digits}, {check}) else concat({digits}, tail) end"


def _surrogate() -> str:
    """SQL: an entity's surrogate for a draw, from columns kind, norm, shape, draw, hexadecimal."""
    card = _spelt("substring(shape, 1, length(shape) - 1)", "1")
    domain = "substring_index(shape, '@', -1)"
    host = f"substring({domain}, 1, length({domain}) - length(substring_index({domain}, '.', -1)))"
    # A host is hashed by itself, so that addresses at one host stay at one host.
    own_host = _spelt(host).replace("kind, norm, draw", f"'host', {host}, 0")
    octets = "array_join(transform(split(shape, '[.]'), (c, i) -> case when i < kept then c else cast({} % 254 + 1 as string) end), '.')"
    octets = octets.format(_random("i")).replace("i < kept", f"i < {_PRIVATE}")
    names = []
    for script, parts in SYLLABLES.items():
        syllables = "array(" + ", ".join(f"'{p}'" for p in parts) + ")"
        stem = f"array_join(transform(sequence(0, 2 + int(draw / 8)), i -> element_at({syllables}, cast({_random('i')} % {len(parts)} as int) + 1)), '')"
        ends = " ".join(f"when right(kind, 1) = '{g}' then '{e}'" for g, e in ENDINGS[script].items())
        names.append((script, f"initcap(concat({stem}, case {ends} else '' end))"))
    script = "case when norm rlike '\\\\p{IsCyrillic}' then 'cyrillic' when norm rlike '\\\\p{IsGreek}' then 'greek' else 'latin' end"
    name = "case " + " ".join(f"when {script} = '{s}' then lower({n})" for s, n in names) + " end"
    return f"""case
        when kind = 'card' then concat({card}, cast((10 - {_check(f"concat({card}, '0')")} % 10) % 10 as string))
        when kind = 'phone' then {_spelt("shape", "country")}
        when kind = 'iban' then {_spelt("shape", "2")}
        when kind = 'key' then {_spelt("shape", "4")}
        when kind = 'ip' then {octets}
        when kind = 'mail' then concat({_spelt("substring_index(shape, '@', 1)")}, '@', {own_host}, substring_index({domain}, '.', -1))
        when kind like 'name%' and norm like '_.' then concat(left({name}, 1 + int(draw / 4)), '.')
        when kind like 'name%' then {name}
        else {_spelt("shape")}
    end"""


def _dealt(left: DataFrame, held: DataFrame) -> DataFrame:
    """Rows (kind, norm, dealt): for those of `left`, free values of their classes by rank.

    Only classes that are nearly full come here, so that there are not many more values than
    entities; larger ones, and names, which get longer by themselves, are drawn on.
    """
    tail = F.expr("case when kind = 'mail' then substring(surrogate, instr(surrogate, '@')) else '' end")
    left = left.where("kind not like 'name%'").withColumns({"class": F.expr(_class()), "tail": tail})
    size = F.expr("if(kind = 'ip', pow(254D, 4 - size(class)), aggregate(class, 1D, (n, x) -> n * length(x)))")
    left = left.withColumn("size", size).where(F.col("size") < _MANY).drop("size")
    group = ["kind", "class", "tail"]
    ranked = lambda rows, by: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.sha2(by, 256), by)))
    runs = left.select(*group, "secret_key").distinct().withColumn("size", size.cast("long"))
    runs = runs.withColumn("run", F.explode(F.expr(f"sequence(0L, (size - 1) div {_RUN})"))).repartition(*group, "run")
    values = runs.withColumn("number", F.explode(F.expr(f"sequence(run * {_RUN}, least(size, (run + 1) * {_RUN}) - 1)")))
    values = values.withColumn("surrogate", F.expr(_numbered())).join(held, ["kind", "surrogate"], "left_anti")
    free = ranked(values, F.concat("secret_key", "surrogate")).select(*group, "rank", F.col("surrogate").alias("dealt"))
    return ranked(left, F.concat("secret_key", "norm")).join(free, [*group, "rank"]).select("kind", "norm", "dealt")


def _entities(distinct: DataFrame, key: str) -> DataFrame:
    """Rows (kind, norm, surrogate) for distinct (kind, norm, country).

    Who shares a surrogate, or has one that is an entity, draws again; every `_DRAWS` draws
    free values are dealt out, and who gets none draws in a wider class.
    """
    hexadecimal = F.expr("norm rlike '^[0-9a-f]+$' or kind = 'secret' and norm rlike '^[0-9A-F]+$'")
    columns = {"secret_key": F.lit(key), "hexadecimal": hexadecimal, "draw": F.lit(0), "width": F.lit(0), "shape": F.col("norm")}
    drawn = stored(distinct.withColumns(columns).withColumn("surrogate", F.expr(_surrogate())), "pii-drawn")
    originals = drawn.select("kind", F.col("norm").alias("surrogate")).distinct()
    for turn in itertools.count(1):
        shared = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("owner"), F.count("*").alias("n"))
        held = originals.withColumn("original", F.lit(True))
        judged = drawn.join(shared, ["kind", "surrogate"]).join(held, ["kind", "surrogate"], "left")
        again = ((F.col("n") > 1) & (F.col("norm") != F.col("owner"))) | F.col("original").isNotNull()
        judged = stored(judged.withColumn("again", again), "pii-judged")
        if judged.where("again").limit(1).count() == 0:
            return judged.select("kind", "norm", "surrogate")
        redrawn = judged.withColumn("draw", F.col("draw") + F.col("again").cast("int"))
        dealt = F.lit(None).cast("string")
        if turn % _DRAWS == 0:
            taken = judged.where("not again").select("kind", "surrogate").unionByName(originals)
            redrawn = redrawn.join(stored(_dealt(judged.where("again"), taken), "pii-dealt"), ["kind", "norm"], "left")
            redrawn = redrawn.withColumn("width", F.col("width") + (F.col("again") & F.col("dealt").isNull()).cast("int"))
            redrawn, dealt = redrawn.withColumn("shape", F.expr(_SHAPE)), F.col("dealt")
        # A value dealt earlier stays, whatever a draw would give.
        kept = F.when(~F.col("again"), F.col("surrogate"))
        redrawn = redrawn.withColumn("surrogate", F.coalesce(dealt, kept, F.expr(_surrogate())))
        drawn = stored(redrawn.select(*distinct.columns, *columns, "surrogate"), "pii-drawn")


def _poured() -> str:
    """SQL: the surrogate in the format of the mention."""
    # Letters and digits of the mention are replaced one by one, in its case.
    step = (
        "named_struct('at', s.at + if(c rlike '[\\\\p{L}\\\\p{N}]' or not loose, 1, 0), 'out', concat(s.out, "
        "case when loose and not c rlike '[\\\\p{L}\\\\p{N}]' then c "
        "when c <> lower(c) then upper(substring(surrogate, s.at + 1, 1)) else substring(surrogate, s.at + 1, 1) end))"
    )
    # A surrogate of a wider class is longer than the mention; in a mail address the host follows.
    return (
        "case when kind = 'ip' then surrogate when kind like 'name%' then initcap(surrogate) "
        "when kind = 'mail' and length(surrogate) > length(mention) then surrogate else "
        f"aggregate(split(mention, ''), named_struct('at', 0, 'out', ''), (s, c) -> {step}, s -> concat(s.out, substring(surrogate, s.at + 1))) end"
    )


def _mentions(texts: DataFrame) -> DataFrame:
    """Rows (digest, mention, kind, norm, country): what is to be replaced in each distinct text.

    A person is one row for each name, the last of which is the family name.
    """
    found = texts.select("digest", F.explode("found").alias("mention")).distinct().withColumn("kind", F.expr(_kind("mention")))
    found = found.where("kind is not null")
    titles = _quoted(rf"^{_TITLED}")
    first = _quoted(rf"^({_TITLE})(?!\p{{L}})")
    genders = " ".join(f"when title in ({', '.join(_quoted(t) for t in ts)}) then '{g}'" for g, ts in TITLES.items())
    people = (
        found.where("kind = 'person'")
        .withColumn("title", F.expr(f"rtrim('.', regexp_extract(mention, {first}, 1))"))
        .withColumn("names", F.expr(f"split(regexp_replace(mention, {titles}, ''), '\\\\s+')"))
        .withColumn("gender", F.expr(f"case {genders} else 'n' end"))
        .withColumn("gender", F.expr("case when gender <> 'n' then gender when lower(names[0]) rlike '[aαая]$' then 'f' else 'm' end"))
    )
    names = people.select("digest", F.explode(F.expr(
        "transform(names, (x, i) -> named_struct('mention', x, 'kind', if(i = size(names) - 1, 'name family', concat('name ', gender))))"
    )).alias("n")).select("digest", "n.mention", "n.kind")
    # Were a bare name known under two kinds in one text, the first by name of kind counts.
    names = names.groupBy("digest", "mention").agg(F.min("kind").alias("kind"))
    rest = found.where("kind <> 'person'").select("digest", "mention", "kind")
    country = "if(mention like '+%', length(regexp_extract(mention, '^[+]([0-9]{1,3})', 1)), 0)"
    return rest.unionByName(names).withColumns({
        "country": F.expr(f"case when kind = 'phone' then {country} else 0 end"),
        "norm": F.expr(
            "case when kind in ('card', 'phone', 'ssn', 'iban') then regexp_replace(mention, '[^A-Za-z0-9]', '') "
            "when kind in ('mail', 'hash') or kind like 'name%' then lower(mention) else mention end"
        ),
    })


def _replaced(text: Column, pattern: Column, by: Column) -> tuple[Column, Column]:
    """The text with mapped mentions replaced, and how many were."""
    found = F.expr("regexp_extract_all(pii_text, pii_pattern, 0)")
    new = F.transform(found, lambda m: F.coalesce(F.try_element_at(by, m), m))
    between = F.expr("split(pii_text, pii_pattern, -1)")
    whole = F.array_join(F.flatten(F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    return whole, F.size(F.filter(found, lambda m: F.map_contains_key(by, m)))


def replace(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`df` with `text` replaced and `n_replaced`, the mentions replaced, added."""
    columns = [c for c in df.columns if c != "n_replaced"]
    signs = F.coalesce(F.col(text).rlike(SIGNS), F.lit(False))
    digest = F.sha2(F.col(text), 256)
    found = df.where(signs).select(digest.alias("digest"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found"))
    found = stored(found.where(F.size("found") > 0).groupBy("digest").agg(F.first("found").alias("found")), "pii-found")
    mentions = stored(_mentions(found), "pii-mentions")
    distinct = mentions.groupBy("kind", "norm").agg(F.max("country").alias("country"))
    entities = stored(_entities(distinct, key), "pii-entities")
    known = mentions.join(entities, ["kind", "norm"]).withColumn("loose", F.expr("kind in ('card', 'phone', 'ssn', 'iban')"))
    known = known.withColumn("by", F.expr(_poured()))
    maps = known.groupBy("digest").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "by"))).alias("pii_map"),
        F.collect_list(F.when(F.col("kind").like("name%"), F.col("mention"))).alias("pii_names"),
    )
    # Longer ones first, as a name may begin with another; of its signs only a dot is special.
    longest = F.expr("replace(array_join(array_sort(pii_names, (a, b) -> length(b) - length(a)), '|'), '.', '[.]')")
    names = F.concat(F.lit(r"|(?<![\p{L}])(?:"), longest, F.lit(r")(?![\p{L}])"))
    # A person's title stays; the names behind it are replaced like bare ones.
    plain = "(?:" + "|".join(p for k, p in PATTERNS.items() if k != "person") + ")"
    maps = maps.withColumn("pii_pattern", F.concat(F.lit(plain), F.when(F.size("pii_names") > 0, names).otherwise("")))
    maps = stored(maps.drop("pii_names"), "pii-maps")

    inner = [f"c{i}" for i in range(len(columns))]
    own = df.select(*columns).toDF(*inner)
    mine = inner[columns.index(text)]
    has = F.coalesce(F.col(mine).rlike(SIGNS), F.lit(False))
    touched = own.where(has).withColumn("digest", F.sha2(F.col(mine), 256)).join(maps, "digest", "left")
    touched = touched.withColumn("pii_text", F.col(mine))
    whole, count = _replaced(F.col(mine), F.col("pii_pattern"), F.col("pii_map"))
    mapped = F.col("pii_map").isNotNull()
    touched = touched.withColumns({
        mine: F.when(mapped, whole).otherwise(F.col(mine)), "n_replaced": F.when(mapped, count).otherwise(0),
    })
    untouched = own.where(~has).withColumn("n_replaced", F.lit(0))
    out = reduce(DataFrame.unionByName, [x.select(*inner, "n_replaced") for x in (untouched, touched)])
    return out.toDF(*columns, "n_replaced")
