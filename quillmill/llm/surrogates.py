"""PII surrogates: detected entities are replaced by keyed, type-consistent stand-ins.

Only DataFrame functions are used.  One regular expression finds e-mail addresses,
telephone numbers, IP addresses of both versions, card and account numbers, secrets and
titled names; it runs over every text once.  What a match means is told by its canonical
form: lower case for addresses and names, digits for numbers, of a telephone number the last
ten without the country's code and leading zeros.  So "+1 (988) 555-2485" and "988-555-2485"
are one telephone, "BERG" and "Berg" one name.  The parts of a name are entities of their
own, so that "Frau Anna Berg" and "Frau Berg" go on meaning one person.

Each canonical entity of the corpus gets one surrogate, by a keyed hash; each occurrence has
it in its own spelling: upper and lower case where they were, separators as they were, the
country's code kept.  Letters stay letters of the same script and digits digits; octets stay
octets, and an address of version 6 becomes a full one; a card number that passes Luhn's test
keeps passing it, and account numbers get check digits that are valid; the title, and with it
the gender, of a name decides how the new given name ends.

Distinctness is checked, not assumed: surrogates of one kind that coincide, or that are
themselves an entity of the corpus, are drawn again, all but one, until none coincide.

Documents are written down with their matches.  Those without an entity are passed through
unshuffled; those with one are joined with a map of their own entities by a hash of the
text; should two texts share a hash, their maps are merged and each still finds its entities.

The key has no default: whoever knows it can find out what a surrogate stands for by trying.

Defined cases: a null text stays null and an empty one empty, with no entities.
Repeated rows get equal results.  Null ids are allowed: the id is not used.  Other
columns pass through under their names; the result adds ``n_entities``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.staging import drop, stage

# The shapes that count as personal.  Open-ended repetitions are possessive and begin where a run of
# their characters does (or a match has ended, \G), so that no text takes quadratic time.
EMAIL = r"(?:\G|(?<![\p{L}\p{N}._%+\-]))[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){1,126}"
PHONE = r"(?<![\d+])\+?\d{1,3}[ .\-]?\(\d{2,4}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .\-]\d{2,4}){2,4}(?!\d)|(?<![\d\-])\d{3}-\d{3}-\d{4}(?![\d\-])"
PHONE += r"|(?<![\d+])\+[1-9]\d{6,14}(?!\d)|(?<![\d+])\+\d{1,3}[ .\-]?\(?\d{1,5}\)?(?:[ .\-]\d{2,8}){1,4}(?!\d)|(?<![\p{L}\p{N}])\(\d{2,5}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)"
PHONE += r"|(?<![\d.,\-])(?:\d{3}\.\d{3}\.\d{4}|(?<!\d )\d{3} \d{3} \d{4}|0\d(?:[ .\-]\d\d){4}|0\d{2,4} \d{3,4} \d{3,4}|0\d{2,4}[ /\-]\d{6,8})(?![\d\-]|[.,]\d)"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)"
_GROUP = "[0-9A-Fa-f]{1,4}"
IPV6 = rf"(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*+\d)(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{1,7}}:(?:{_GROUP}(?::{_GROUP}){{0,5}})?|::{_GROUP}(?::{_GROUP}){{0,6}})(?![\p{{L}}\p{{N}}:])"
HEX = r"(?<![\p{L}\p{N}])(?=[a-fA-F]*+\d)(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])"
SECRET_PREFIX = r"(?:AKIA|gh[opsur]_|github_pat_|sk-|xox[abprs]-|AIza)"
SECRET = r"(?<![\p{L}\p{N}])(?:(?:AKIA[0-9A-Z]{16}|AIza[A-Za-z0-9_\-]{35})(?![\p{L}\p{N}])|gh[opsur]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+|sk-[A-Za-z0-9_\-]{20,}+|xox[abprs]-[A-Za-z0-9\-]{10,}+)"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?(?=[A-Z0-9]{0,3}\d)[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Señora|Señorita|Sra|Srta|Madame|Mademoiselle|Mme|Mlle|Госпожа"
MALE_TITLES = "Mr|Herr|Señor|Monsieur|Господин"
PERSON = rf"(?<![\p{{L}}\p{{N}}])(?:{FEMALE_TITLES}|{MALE_TITLES})\.? \p{{Lu}}[\p{{L}}'’\-]{{1,40}}(?: \p{{Lu}}[\p{{L}}'’\-]{{1,40}}){{0,2}}"
ANY = "|".join((EMAIL, PHONE, IP, IPV6, HEX, SECRET, IBAN, SSN, CARD, PERSON))
HINT = rf"[0-9@]|{SECRET_PREFIX}|(?:{FEMALE_TITLES}|{MALE_TITLES})\.? \p{{Lu}}"  # every entity has one of these

DIGITS, LATIN, GREEK, CYRILLIC = "0123456789", "abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыэюя"
SYLLABLES = {
    "latin": "ba den ki lor ma nel ri sa tor vel mi jo ha per li gun".split(),
    "cyrillic": "ба ден ки лор ма нел ри са тор вел ми ге ха пер ли гун".split(),
    "greek": "βα δεν κι λορ μα νελ ρι σα τορ βελ μι γε χα περ λι γουν".split(),
}
ENDINGS = {
    "latin": {"female": "na", "male": "n", "family": "berg"},
    "cyrillic": {"female": "на", "male": "н", "family": "енко"},
    "greek": {"female": "να", "male": "ν", "family": "ίδη"},
}


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def kind(m: Column) -> Column:
    """What a match is; tried in the order in which the alternatives are."""
    c = F.when(m.rlike(r"^[^ ]*@"), "email").when(m.rlike(rf"^(?:{FEMALE_TITLES}|{MALE_TITLES})\.? \p{{Lu}}"), "person")
    c = c.when(m.rlike(_whole(IP)), "ip").when(m.rlike(_whole(IPV6)), "ipv6").when(m.rlike(_whole(r"[0-9a-f]{32,}+|[0-9A-F]{32,}+")), "hex")
    c = c.when(m.rlike(rf"^{SECRET_PREFIX}"), "secret").when(m.rlike(_whole(IBAN)), "iban").when(m.rlike(_whole(SSN)), "ssn")
    return c.when(m.rlike(_whole(CARD)), "card").otherwise("phone")


def _bare(s: Column, wanted: str = "0-9") -> Column:
    return F.regexp_replace(s, f"[^{wanted}]", "")


def canonical(k: Column, m: Column) -> Column:
    """What all spellings of an entity that is no name have in common."""
    country = F.regexp_replace(m, r"^\+(?:\d{1,3}(?!\d)|\d)", "")
    national = F.regexp_replace(_bare(F.when(m.startswith("+"), country).otherwise(m)), "^0+(?=.)", "")
    out = F.when(k.isin("email", "ipv6", "hex"), F.lower(m)).when(k == "phone", F.right(national, F.lit(10)))
    return out.when(k.isin("card", "ssn"), _bare(m)).when(k == "iban", F.replace(m, F.lit(" "), F.lit(""))).otherwise(m)


def keys(m: Column) -> Column:
    """The entities in a match, each as kind, a tab, and its canonical form: one, or for a person one for each part of the name."""
    words = F.slice(F.split(m, " "), 2, 10)
    sex = F.when(m.rlike(rf"^(?:{FEMALE_TITLES})\.? "), "female").otherwise("male")
    parts = F.transform(words, lambda w, i: F.concat(F.when(i == F.size(words) - 1, "family").otherwise(sex), F.lit("\t"), F.lower(w)))
    k = kind(m)
    return F.when(k == "person", parts).otherwise(F.array(F.concat(k, F.lit("\t"), canonical(k, m))))


def respelled(k: Column, m: Column, new: Column) -> Column:
    """A surrogate of a canonical form in the spelling of an occurrence."""
    letters = "0-9A-Za-z"
    whole = _bare(m, letters)
    full = F.concat(F.substr(whole, F.lit(1), F.length(whole) - F.length(new)), new)
    nth = lambda i: F.length(_bare(F.substr(m, F.lit(1), i + 1), letters))
    filled = F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike(f"[{letters}]"), F.substr(full, nth(i), F.lit(1))).otherwise(c)), "")
    cased = F.array_join(F.transform(F.split(new, ""), lambda c, i: F.when(F.substr(m, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    out = F.when(k.isin("phone", "card", "ssn", "iban"), filled)
    out = out.when((k == "email") & (F.length(m) == F.length(new)), cased)
    return out.when(k.isin("ipv6", "hex") & m.rlike("[A-F]"), F.upper(new)).otherwise(new)


def rebuilt(m: Column, surrogates: Column) -> Column:
    """A match with its entities replaced."""
    found = F.transform(keys(m), lambda k: F.try_element_at(surrogates, k))
    words = F.split(m, " ")
    loud = lambda w: (F.upper(w) == w) & (F.length(w) > 1)
    parts = F.transform(found, lambda new, i: F.when(loud(F.get(words, i + 1)), F.upper(new)).otherwise(new))
    person = F.concat(F.get(words, 0), F.lit(" "), F.array_join(parts, " "))
    return F.when(kind(m) == "person", person).otherwise(respelled(kind(m), m, F.get(found, 0)))


def _byte(h: Column, i: Column) -> Column:
    """Byte i (modulo 60) of a hash of 128 hexadecimal digits."""
    return F.conv(F.substr(h, F.pmod(i, F.lit(60)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, v: Column) -> Column:
    return F.substr(F.lit(alphabet), F.pmod(v, F.lit(len(alphabet))) + 1, F.lit(1))


def _spelled(s: Column, h: Column, keep: Column | int = 0, digits: str = DIGITS, lower: str = LATIN) -> Column:
    """``s`` with every letter and digit after the first ``keep`` drawn anew within its class."""
    keep = F.lit(keep) if isinstance(keep, int) else keep

    def one(c: Column, i: Column, fixed: Column) -> Column:
        v = _byte(fixed["h"], i)
        out = F.when(i <= fixed["keep"], c).when(c.rlike("[0-9]"), _pick(digits, v)).when(c.rlike("[a-z]"), _pick(lower, v)).when(c.rlike("[A-Z]"), _pick(lower.upper(), v))
        for script, alphabet in (("IsCyrillic", CYRILLIC), ("IsGreek", GREEK), ("L", LATIN)):
            out = out.when(c.rlike(rf"\p{{{script}}}"), F.when(c == F.lower(c), _pick(alphabet, v)).otherwise(_pick(alphabet.upper(), v)))
        return out.otherwise(c)

    # bound once: else each character would hash the whole entity anew
    once = F.array(F.struct(h.alias("h"), keep.alias("keep")))
    return F.element_at(F.transform(once, lambda fixed: F.array_join(F.transform(F.split(s, ""), lambda c, i: one(c, i + 1, fixed)), "")), 1)


def _luhn(s: Column) -> Column:
    """Luhn's sum of the digits of ``s``, modulo 10."""
    digits = F.reverse(F.regexp_replace(s, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add), F.lit(10))


def _card(s: Column, h: Column) -> Column:
    new = _spelled(s, h, 1)
    bare = F.concat(F.substr(new, F.lit(1), F.length(s) - 1), F.lit("0"))
    fixed = F.concat(F.substr(new, F.lit(1), F.length(s) - 1), F.pmod(-_luhn(bare), F.lit(10)).cast("string"))
    return F.when(_luhn(s) == 0, fixed).otherwise(new)


def _iban(s: Column, h: Column) -> Column:
    """Country, valid check digits, and the rest drawn anew."""
    country, rest = F.substring(s, 1, 2), F.substr(_spelled(s, h, 4), F.lit(5))
    digits = F.split(F.concat(rest, country, F.lit("00")), "")

    def add(total: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return F.pmod(total * F.when(value > 9, 100).otherwise(10) + value, F.lit(97))

    check = F.lit(98) - F.aggregate(digits, F.lit(0), add)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)


def _name(s: Column, h: Column, role: str, attempt: Column) -> Column:
    def made(script: str) -> Column:
        syllables = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        count = F.lit(2) + F.least(attempt, F.lit(3))
        body = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.get(syllables, F.pmod(_byte(h, i), F.lit(16)))), "")
        return F.initcap(F.concat(body, F.lit(ENDINGS[script][role])))

    return F.when(s.rlike(r"\p{IsCyrillic}"), made("cyrillic")).when(s.rlike(r"\p{IsGreek}"), made("greek")).otherwise(made("latin"))


def surrogate(key: Column, attempt: Column, secret: str) -> Column:
    """The stand-in of a canonical entity (kind, tab, text) on its n-th draw."""
    k, s = F.substring_index(key, "\t", 1), F.substr(key, F.instr(key, "\t") + 1)
    h = F.sha2(F.concat_ws("\x1f", F.lit(secret), key, attempt.cast("string")), 512)
    local, domain = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
    stem = F.substr(domain, F.lit(1), F.length(domain) - F.length(F.substring_index(domain, ".", -1)))
    email = F.concat(_spelled(local, h), F.lit("@"), _spelled(stem, F.sha2(h, 512)), F.substring_index(domain, ".", -1))
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.pmod(_byte(h, i), F.lit(254)).cast("int") + 1), ".")
    prefix = F.length(F.regexp_extract(s, rf"^{SECRET_PREFIX}", 0))
    ipv6 = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substr(h, i * 4 + 1, F.lit(4))), ":")
    out = F.when(k == "email", email).when(k == "ip", ip).when(k == "ipv6", ipv6).when(k == "hex", _spelled(s, h, 0, DIGITS, "abcdef"))
    out = out.when(k == "secret", _spelled(s, h, prefix)).when(k == "iban", _iban(s, h)).when(k == "card", _card(s, h)).when(k.isin("phone", "ssn"), _spelled(s, h))
    for role in ("female", "male", "family"):
        out = out.when(k == role, _name(s, h, role, attempt))
    return out


def dictionary(entities: DataFrame, secret: str) -> DataFrame:
    """``(key, surrogate)`` for a table of distinct keys; one to one within a kind, and never an entity of the corpus."""
    entities = stage(entities.select("key"), "entities")
    # few bytes, but much to work out for each: dealt to all tasks
    n = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = entities.repartition(n, "key").withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(F.col("key"), F.lit(0), secret))
    now = stage(drawn, "surrogates")
    real = entities.select(F.substr("key", F.instr("key", F.lit("\t")) + 1).alias("surrogate"), F.substring_index("key", "\t", 1).alias("kind"))
    real = real.withColumn("surrogate", F.when(F.col("kind").isin(*ENDINGS["latin"]), F.initcap("surrogate")).otherwise(F.col("surrogate"))).distinct()
    while True:
        marked = now.withColumn("kind", F.substring_index("key", "\t", 1))
        first = marked.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "key"))["key"].alias("owner"))
        first = first.join(real.withColumn("taken", F.lit(True)), ["kind", "surrogate"], "left")
        judged = marked.join(first, ["kind", "surrogate"]).select("key", "attempt", "surrogate", ((F.col("owner") != F.col("key")) | F.col("taken").isNotNull()).alias("again"))
        judged = stage(judged, "judged")
        drop(now)
        if not judged.where("again").limit(1).count():
            return judged.select("key", "surrogate")
        attempt = F.col("attempt") + 1
        again = lambda new, old: F.when(F.col("again"), new).otherwise(F.col(old)).alias(old)
        now = stage(judged.select("key", again(attempt, "attempt"), again(surrogate(F.col("key"), attempt, secret), "surrogate")), "surrogates")


def replace(docs: DataFrame, *, secret: str, text_col: str = "text", extra: str = "n_entities") -> DataFrame:
    """``docs`` with its entities replaced, and the number of them in ``extra``, which replaces a column of that name."""
    docs = docs.drop(extra)
    names, at = docs.columns, docs.columns.index(text_col)
    text, m = F.col(f"c{at}"), F.col("m")
    matches = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    marked = stage(docs.toDF(*[f"c{k}" for k in range(len(names))]).withColumn("m", matches), "marked")
    hit, none = marked.where(F.size("m") > 0), F.coalesce(F.size("m"), F.lit(0)) <= 0
    found = hit.select(F.xxhash64(text).alias("h"), F.array_distinct(F.flatten(F.transform(m, keys))).alias("ks"))
    found = stage(found.select("h", F.explode_outer("ks").alias("key")).distinct().where("key IS NOT NULL"), "found")
    known = dictionary(found.select("key").distinct(), secret)
    maps = found.join(known, "key").groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("key", "surrogate"))).alias("map"))
    maps = stage(maps, "maps")
    # the size of ``maps`` is known from its files: the optimiser broadcasts it only below its limit
    rows = hit.withColumn("h", F.xxhash64(text)).join(maps, "h")
    new = F.array_join(F.zip_with(F.split(text, ANY), m, lambda piece, x: F.concat(piece, F.when(x.isNull(), "").otherwise(rebuilt(x, F.col("map"))))), "")
    changed = rows.withColumn(extra, F.size("m")).withColumn(f"c{at}", new).select(*[f"c{k}" for k in range(len(names))], extra)
    return changed.unionByName(marked.where(none).withColumn(extra, F.lit(0)).drop("m")).toDF(*names, extra)


TEST_KEY = "a key for tests: not for texts that matter"


def op3_pii(spark, sf_dir: str) -> DataFrame:
    """Query: every document with its text as published, and the number of entities replaced."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace(docs, secret=TEST_KEY)
