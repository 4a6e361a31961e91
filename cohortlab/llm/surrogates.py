"""Personal data replaced by keyed surrogates (SQL functions only).

A detected entity is cut into parts (a mail address into its local part and
its domain, a name into its words).  Every distinct part of the corpus gets one
surrogate of its kind from a keyed hash: letters stay letters of their script,
vowels vowels, digits digits, given names end as their gender's do, card
numbers keep a valid check digit.  Parts whose surrogates meet each other's, or
any original, are drawn again until none do.  A part has the same surrogate in
whatever format it is written, and each mention keeps its own punctuation and
case, so equal entities stay equal and different ones different.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import join_rows, keyed, partitions
from cohortlab.plans.guards import materialize

MALE = ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Signor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Sra", "Señorita", "Madame", "Mme", "Signora", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Doctor", "Doktor", "Prof", "Professor", "Mx", "Dott", "Доктор", "Профессор")
TITLE = rf"(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.?\x20"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORD = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)*"
# Tried in this order; the first that fits the mention is its kind.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z]{4})?(?:\x20?[0-9]{4}){2,6}(?:\x20?[0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?:[\x20-]?[0-9]{1,3})?|3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}"
            r"|3[0689][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{4}|(?:2131|1800)[0-9]{11}|4[0-9]{12})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[\x20.-]?)?\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[\x20.-][0-9]{2,4}){2,5}(?![0-9])"
             r"|(?<![0-9.-])[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{TITLE}){{1,3}}(?:{_WORD}\x20){{0,2}}{_WORD}",
}
EVERY = "|".join(f"(?:{r})" for r in KINDS.values())
# In texts with names also every other capitalised word, but for those in a mail address.
BARE = r"(?<![\p{L}\p{N}])\p{Lu}\p{L}++(?:-\p{Lu}\p{L}++)*+(?![\p{N}]|[\p{L}\p{N}._%+-]*@)"
EVERY_WORD = rf"{EVERY}|(?:{BARE})"
NAMES = ("given_m", "given_f", "given", "surname")
# Without an @ there is no mail address, and all else starts with one of these.
NO_MAIL = r"(?=[0-9+(\p{Lu}])(?:" + "|".join(f"(?:{r})" for k, r in KINDS.items() if k != "email") + ")"

# Letters by kind: a letter is replaced by one of its own row.
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäãéèêëíìîïóòôöõúùûü", "ñçßøåœæ",
             "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
             "šžčćřňťďłńśźżğşșț", "ąęėįųūőűāēīōăů", "ёіїєґўјљњћџђ", "άέήίόύώ")


def _other_rows() -> tuple:
    """Rows of all other small letters that have a capital, one row a script
    (the first word of a letter's Unicode name)."""
    rows, listed = {}, set("".join(ALPHABETS))
    for c in map(chr, range(0x80, 0x20000)):
        if unicodedata.category(c) == "Ll" and c not in listed and len(c.upper()) == 1 and c.upper().lower() == c:
            rows.setdefault(unicodedata.name(c, "?").split()[0], []).append(c)
    return tuple("".join(r) for r in rows.values())


ROWS = ALPHABETS + _other_rows()
PLAIN = ALPHABETS[2]       # for letters of no row
SPARE = 8          # draws with the same length; later ones grow by a character each
MOST_DRAWS = 200


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` needs it within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def luhn_digit(digits: Column) -> Column:
    """Check digit for the digits before it."""
    def double(i):
        d = F.substring(digits, i, 1).cast("int") * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + double(i))
    return ((F.lit(10) - total % 10) % 10).cast("string")


def surrogate(kind: Column, value: Column, draw: Column, key: str) -> Column:
    """The surrogate of a part at its ``draw``-th drawing."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, draw.cast("string")), 512)

    def number(i, digest=digest):
        return F.conv(F.substring(digest, (i * 2) % 120 + 1, 4), 16, 10).cast("int")

    def letter(c, i, digest):
        def drawn(row):
            return F.substring(F.lit(row), number(i, digest) % len(row) + 1, 1)
        out = F.when(F.rlike(c, F.lit(r"\p{L}")), drawn(PLAIN)).otherwise(c)
        for row in reversed(ROWS):
            out = F.when(F.contains(F.lit(row), c), drawn(row)).otherwise(out)
        return out

    plain = _bound(F.struct(F.split(value, "").alias("c"), digest.alias("d")),
                   lambda s: F.array_join(F.transform(s["c"], lambda c, i: letter(c, i + 1, s["d"])), ""))
    head = F.substring(plain, F.lit(1), F.length(plain) - 1)
    cyrillic, greek = F.rlike(value, F.lit("[а-я]")), F.rlike(value, F.lit("[α-ω]"))
    female = F.concat(head, F.when(cyrillic, "а").when(greek, "α").otherwise("a"))
    male = F.concat(head, F.substring(F.when(cyrillic, "нрдлс").when(greek, "ςςςςς").otherwise("nrdls"), number(F.lit(59)) % 5 + 1, 1))
    octets = F.array_join(F.transform(F.split(value, r"\."), lambda o, i:
        F.when(draw >= SPARE, number(i + 1) % 254 + 1).when(F.length(o) == 1, number(i + 1) % 9 + 1)
        .when(F.length(o) == 2, number(i + 1) % 90 + 10).otherwise(number(i + 1) % 156 + 100).cast("string")), ".")
    body = F.substring(plain, F.lit(1), F.length(plain) - 1)
    grown = F.when((draw >= SPARE) & ~kind.isin("ip", "card", "phone", "ssn", "iban"),
                   F.substring(F.translate(digest, "0123456789", "ghijklmnop"), F.lit(100), draw - SPARE + 1)).otherwise("")
    return F.concat(F.when(kind == "ip", octets).when(kind == "card", F.concat(body, luhn_digit(body)))
                    .when(kind == "given_f", female).when(kind == "given_m", male).otherwise(plain), grown)


def overlay(raw: Column, letters: Column) -> Column:
    """``raw`` with its letters and digits replaced in order, its case and punctuation kept."""
    def step(s, c):
        new = F.coalesce(F.get(s["new"], s["at"]), F.lit(""))
        held = F.rlike(c, F.lit(r"[\p{L}\p{N}]"))
        return F.struct((s["at"] + held.cast("int")).alias("at"),
                        F.concat(s["out"], F.when(held, F.when(c != F.lower(c), F.upper(new)).otherwise(new)).otherwise(c)).alias("out"),
                        s["new"].alias("new"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.split(letters, "").alias("new"))
    return F.aggregate(F.split(raw, ""), start, step,
                       lambda s: F.concat(s["out"], F.array_join(F.slice(s["new"], s["at"] + 1, F.size(s["new"])), "")))


def _alike(kind: Column, value: Column, other: Column) -> Column:
    """More than half of the letters and digits are still in their places."""
    same = F.zip_with(F.split(value, ""), F.split(other, ""), lambda x, y: x.eqNullSafe(y))
    return (kind != "ip") & (F.size(F.filter(same, lambda x: x)) * 2 > F.length(value))


def _parts(raw: Column) -> Column:
    """A mention as an array of ``(raw, kind, value)``; kind is null for what stays."""
    def part(piece, kind, value=None):
        value = F.lower(F.regexp_replace(piece, r"[^\p{L}\p{N}]", "")) if value is None else value
        return F.struct(piece.alias("raw"), (F.lit(kind) if isinstance(kind, str) else kind).cast("string").alias("kind"),
                        value.alias("value"))

    def stays(piece):
        return F.struct(piece.alias("raw"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("value"))

    def cut(pattern, group):
        return F.regexp_extract(raw, pattern, group)

    def fits(kind):
        return F.rlike(raw, F.lit(f"^(?:{KINDS[kind]})$"))

    digits = F.regexp_replace(raw, "[^0-9]", "")

    def valid(number):
        return (F.substring(number, F.length(number), F.lit(1))
                == luhn_digit(F.substring(number, F.lit(1), F.length(number) - 1)))

    first16 = r"^([0-9]{4}(?:[\x20-]?[0-9]{4}){3})(.*)$"           # a check code may follow
    titles = cut(rf"^((?:{TITLE})+)", 1)
    words = F.split(F.substring(raw, F.length(titles) + 1, F.length(raw)), " ")
    given = (F.when(F.rlike(titles, F.lit(rf"(?<!\p{{L}})(?:{'|'.join(MALE)})(?!\p{{L}})")), "given_m")
             .when(F.rlike(titles, F.lit(rf"(?<!\p{{L}})(?:{'|'.join(FEMALE)})(?!\p{{L}})")), "given_f").otherwise("given"))
    named = F.transform(words, lambda w, i: part(F.concat(F.lit(" "), w),
                                                 F.when(i == F.size(words) - 1, F.lit("surname")).otherwise(given)))
    mail = r"^([^@]+)(@)(.*)(\.[A-Za-z]+)$"
    return (F.when(fits("email"), F.array(part(cut(mail, 1), "mail_user"), stays(cut(mail, 2)), part(cut(mail, 3), "mail_host"), stays(cut(mail, 4))))
            .when(fits("iban"), F.array(stays(F.substring(raw, 1, 2)), part(F.substring(raw, F.lit(3), F.length(raw)), "iban")))
            .when(fits("ip"), F.array(part(raw, "ip", raw)))
            .when(fits("card"), F.when(valid(digits), F.array(part(raw, "card")))
                  .when((F.length(digits) > 16) & valid(F.substring(digits, 1, 16)), F.array(part(cut(first16, 1), "card"), stays(cut(first16, 2))))
                  .otherwise(F.array(stays(raw))))
            .when(fits("ssn"), F.array(part(raw, "ssn")))
            .when(fits("phone"), F.array(stays(cut(r"^(\+[0-9]{1,3})?", 1)), part(F.regexp_replace(raw, r"^\+[0-9]{1,3}", ""), "phone")))
            .when(fits("name"), F.concat(F.array(stays(F.rtrim(titles))), named))
            .when(F.rlike(raw, F.lit(f"^(?:{BARE})$")), F.array(part(raw, "bare")))
            .otherwise(F.array(stays(raw))))


def surrogate_table(parts: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` for distinct parts; no two values of a kind
    share a surrogate, no surrogate is a value of its kind, and none keeps more
    than half of its value's letters in place."""
    # dealt by hand: the parts are few bytes, which Spark would leave to one task, but each takes a hash per letter
    table = materialize(parts.repartition(partitions(parts), "kind", "value").distinct().withColumn("draw", F.lit(0))
                        .withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("draw"), key)), "pii-table")
    originals = table.select(F.col("kind").alias("_k"), F.col("value").alias("_v"))
    for _ in range(MOST_DRAWS):
        # drawn first, then by value: the earlier keeps its surrogate
        place = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("draw", "value"))
        bad = (F.col("place") > 1) | F.col("_v").isNotNull() | _alike(F.col("kind"), F.col("value"), F.col("surrogate"))
        seen = (table.withColumn("place", place)
                .join(originals, (F.col("kind") == F.col("_k")) & (F.col("surrogate") == F.col("_v")), "left")
                .withColumn("bad", bad).drop("place", "_k", "_v"))
        seen = materialize(seen, "pii-table")
        if seen.where("bad").isEmpty():
            return seen.select("kind", "value", "surrogate")
        again = F.col("draw") + F.col("bad").cast("int")
        table = seen.select("kind", "value", again.alias("draw"),
                            F.when(F.col("bad"), surrogate(F.col("kind"), F.col("value"), again, key))
                            .otherwise(F.col("surrogate")).alias("surrogate"))
    raise RuntimeError("no free surrogates are left for some kind of entity")


def replace_entities(docs: DataFrame, key: str = "public-demo-key", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_entities, text`` with every detected
    entity replaced.

    Kinds: mail addresses, IBANs, IPv4 addresses, card numbers with a valid
    check digit, social security numbers, telephone numbers, and names: after a
    title, and each word of such a name wherever else the same text has it
    capitalised.  The same key gives the same surrogates.  Null text becomes empty;
    null and repeated ids and repeated rows are treated each; an empty table
    gives no rows.
    """
    base = keyed(docs, id_col, text_col)
    found = F.when(F.contains("text", F.lit("@")), F.regexp_extract_all("text", F.lit(EVERY), F.lit(0))).otherwise(
        F.regexp_extract_all("text", F.lit(NO_MAIL), F.lit(0)))

    def cut_up(rows, found):
        return (rows.select("doc_id", "k", F.posexplode(found).alias("i", "mention"))
                .select("doc_id", "k", "i", F.posexplode(_parts(F.col("mention"))).alias("j", "part"))
                .select("doc_id", "k", "i", "j", "part.*"))
    mentions = materialize(cut_up(base, found), "pii-mentions")
    # a text's names: each word by its first mention, those of known gender before others
    names = materialize(mentions.where(F.col("kind").isin(*NAMES)).groupBy("doc_id", "k", "value")
                        .agg(F.min(F.struct((F.col("kind") == "given").alias("n"), "i", "j", "kind")).alias("first"))
                        .select("doc_id", "k", "value", F.col("first.kind").alias("name_kind")), "pii-names")
    named = materialize(names.select("doc_id", "k").distinct(), "pii-named")
    words = materialize(cut_up(join_rows(base, named, "left_semi").select("doc_id", "k", "text"),
                               F.regexp_extract_all("text", F.lit(EVERY_WORD), F.lit(0))), "pii-words")
    again = names.select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.col("value").alias("_v"), "name_kind")
    looked_up = F.col("kind").isin("bare", "given")
    words = (words.join(again, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")) & (F.col("value") == F.col("_v")), "left")
             .withColumn("kind", F.when(looked_up, F.col("name_kind")).otherwise(F.col("kind")))
             .select("doc_id", "k", "i", "j", "raw", "kind", "value"))
    other = named.select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"))
    mentions = mentions.join(other, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")), "left_anti")
    mentions = materialize(mentions.unionByName(words), "pii-mentions")
    table = surrogate_table(mentions.where("kind is not null").select("kind", "value"), key)
    drawn = (mentions.join(table, ["kind", "value"], "left")
             .withColumn("out", F.when(F.col("surrogate").isNull(), F.col("raw"))
                         .when(F.col("kind") == "ip", F.col("surrogate")).otherwise(overlay(F.col("raw"), F.col("surrogate")))))
    per_text = (drawn.groupBy("doc_id", "k")
                .agg(F.sort_array(F.collect_set(F.struct("i", "j", "out", "kind"))).alias("parts")))      # a text's own mentions
    flagged = per_text.join(named.select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.lit(True).alias("named")),
                            F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")), "left").drop("_d", "_k")
    joined = join_rows(base, flagged, "left").withColumn(
        "gaps", F.when(F.col("named"), F.split("text", EVERY_WORD, -1)).when(F.col("parts").isNotNull(), F.split("text", EVERY, -1)))
    count = F.size(F.array_distinct(F.transform(F.filter("parts", lambda p: p["kind"].isNotNull()), lambda p: p["i"])))
    return joined.select("doc_id", F.when(F.col("parts").isNull(), 0).otherwise(count).cast("long").alias("n_entities"),
                         F.when(F.col("parts").isNull(), F.col("text")).otherwise(_rebuilt()).alias("text"))


def _rebuilt() -> Column:
    """Gaps and replaced mentions in turn.  Sorting both by place keeps this
    near linear in a text with very many mentions."""
    gaps = F.transform("gaps", lambda g, i: F.struct(i.alias("i"), F.lit(-1).alias("j"), g.alias("out")))
    parts = F.transform("parts", lambda p: F.struct(p["i"].alias("i"), p["j"].alias("j"), p["out"].alias("out")))
    return F.array_join(F.transform(F.sort_array(F.concat(gaps, parts)), lambda x: x["out"]), "")
