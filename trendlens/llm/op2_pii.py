"""Operator 2: personal data replaced by format-preserving Feistel pseudonyms (column functions only).

Numbers and dates are found by pattern, validated, and permuted under a key within their own format,
so a pseudonym is again a valid value, equal values have equal pseudonyms in every document, and
different values of one kind never meet:

- `card`: 13 to 19 digits with a right Luhn digit; the other digits are permuted, Luhn's is recomputed; a
  row of digit groups is searched from every group, so short numbers beside a card don't hide it. Usual
  groupings go first, since a card with its neighbour passes Luhn by chance one time in ten;
- `ssn`: ddd-dd-dddd with assignable area, group and serial; permuted among those;
- `phone`: an optional country code (kept) and ten digits; the ten digits are permuted;
- `ip`: four octets up to 255; permuted as 32 bits;
- `date`: a day of 1901 to 2100 as y-m-d, d.m.y, m/d/y (or d/m/y where only that is a date); permuted
  among the days of its century, written the same way;
- `iban`: its country's length and right check digits; letters and digits are permuted in their class, check
  digits recomputed;
- `email`: letters and digits of the local part are permuted in their class; the domain stays.

Separators and brackets stay where they are; the same value under other separators has the same
digits. What fails validation stays as it is; groups beside a card and failed IBANs are read again for other
kinds. Balanced Feistel rounds take a keyed SHA-256 of one
half and add it to the other, modulo the half's own size, so every domain is permuted exactly.

Defined cases: a null text stays null, a text without such values is returned unchanged; texts of any
length are read whole; repeated rows get a row each; an empty table gives an empty result; columns
other than `text` pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import table

KEY = "replace this key in production"      # a parameter of every function below
ROUNDS = 8
KINDS = ("email", "ip", "date", "phone", "ssn", "iban", "card")

# Fixed patterns, in the order in which they are tried at a position.
# A domain has at most LABELS labels (a name of 253 characters has no more); what has more is no address and stays.
# Both repeats are bounded: Java's matcher recurses once for each round of a group.
LABELS = 127
EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?!(?:[A-Za-z0-9-]++\.){" + str(LABELS)
         + r"})[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0," + str(LABELS) + r"}\.[A-Za-z]{2,}")
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE_YMD = r"(?<![0-9])[0-9]{4}(?<y>[-/.])[0-9]{1,2}\k<y>[0-9]{1,2}(?![0-9])"
DATE_DMY = r"(?<![0-9])[0-9]{1,2}(?<d>[-/.])[0-9]{1,2}\k<d>[0-9]{4}(?![0-9])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban(countries: str, length: int) -> str:
    fours, left = divmod(length - 4, 4)
    rest = f" [A-Z0-9]{{{left}}}" if left else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{fours}}}{rest})"


KNOWN = "|".join(_iban(c, n) for n, c in IBAN_LENGTHS.items())
UNKNOWN = rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?)"
IBAN = rf"(?<![A-Za-z0-9])(?:{KNOWN}|{UNKNOWN})(?![A-Za-z0-9])"
# A whole row of digit groups: possessive, so its length costs no stack. Cards are looked for inside.
CARDS = r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+"
USUAL = r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}"
OTHERS = "|".join((EMAIL, IP, DATE_YMD, DATE_DMY, PHONE, SSN, IBAN))
ANY = f"{OTHERS}|{CARDS}"


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digest(key: str, tag: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), turn.cast("string"), half.cast("string"), F.lit(key)), 256)


def number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def feistel(left: Column, right: Column, a: int, b: int, key: str, tag: str) -> Column:
    """Permute (left, right) of [0, a) x [0, b): struct(l, r)."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        add = lambda half, size: F.pmod(half + F.pmod(number(F.substring(digest(key, tag, i, F.when(i % 2 == 0, s["l"]).otherwise(s["r"])), 1, 15)), F.lit(size)), F.lit(size))
        return F.struct(F.when(i % 2 == 0, s["l"]).otherwise(add(s["l"], a)).alias("l"),
                        F.when(i % 2 == 0, add(s["r"], b)).otherwise(s["r"]).alias("r"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def shifted(target: Column, stream: Column) -> Column:
    """Each letter or digit of `target` moved within its class by its part of a hex stream."""
    def move(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        by = F.conv(stream.substr(F.pmod(i, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        within = lambda low, size: F.char(F.pmod(code - low + by, F.lit(size)) + low)
        return (F.when(c.between("0", "9"), within(48, 10)).when(c.between("A", "Z"), within(65, 26))
                .when(c.between("a", "z"), within(97, 26)).otherwise(c))

    return F.array_join(F.transform(F.split(target, ""), move), "")


def feistel_text(value: Column, key: str, tag: str) -> Column:
    """Permute a string of ASCII letters and digits among strings of the same classes at each place."""
    middle = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), middle).alias("l"), F.substr(value, middle + 1).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        return F.struct(F.when(i % 2 == 0, s["l"]).otherwise(shifted(s["l"], digest(key, tag, i, s["r"]))).alias("l"),
                        F.when(i % 2 == 0, shifted(s["r"], digest(key, tag, i, s["l"]))).otherwise(s["r"]).alias("r"))

    done = F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)
    return let(done, lambda x: F.concat(x["l"], x["r"]))


def keep(value: Column, unwanted: str) -> Column:
    return F.regexp_replace(value, unwanted, "")


def laid_over(original: Column, chars: Column, unwanted: str) -> Column:
    """`chars` put in the places of `original` that don't match `unwanted` (one character each)."""
    place = lambda c, i: F.when(c.rlike(unwanted), c).otherwise(
        F.substr(chars, F.length(keep(F.substr(original, F.lit(1), i + 1), unwanted)), F.lit(1)))
    return F.array_join(F.transform(F.split(original, ""), place), "")


def luhn(digits: Column) -> Column:
    """Luhn's sum of a digit string."""
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when((F.length(digits) - i) % 2 == 0, double).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), part), F.lit(0), lambda s, x: s + x)


def card(m: Column, key: str) -> Column:
    digits = keep(m, "[^0-9]")
    body = feistel_text(digits.substr(F.lit(1), F.length(digits) - 1), key, "card")
    check = lambda x: F.pmod(10 - F.pmod(luhn(F.concat(x, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    new = let(body, lambda x: F.concat(x, check(x)))
    return F.when(luhn(digits) % 10 == 0, let(new, lambda x: laid_over(m, x, "[^0-9]")))


def ssn(m: Column, key: str) -> Column:
    area, group, serial = (m.substr(at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    areas = 898                                             # 1 to 899 without 666
    index = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1

    def written(got: Column) -> Column:
        new = F.floor(got["l"] / 99) + 1
        return F.format_string("%03d-%02d-%04d", new + F.when(new >= 666, 1).otherwise(0), got["l"] % 99 + 1, got["r"] + 1)

    return F.when(valid, let(feistel(index, serial - 1, areas * 99, 9999, key, "ssn"), written))


def phone(m: Column, key: str) -> Column:
    digits = keep(m, "[^0-9]")
    code = F.length(digits) - 10
    new = F.concat(digits.substr(F.lit(1), code), feistel_text(F.substr(digits, code + 1), key, "phone"))
    return let(new, lambda x: laid_over(m, x, "[^0-9]"))


def ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    got = feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 1 << 16, 1 << 16, key, "ip")
    four = lambda x: (F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256)
    return F.when(F.forall(octets, lambda x: x < 256), let(got, lambda x: F.concat_ws(".", *[o.cast("int").cast("string") for o in four(x)])))


def date(m: Column, key: str) -> Column:
    """A century of days is 75 * 487 (1901 to 2000) or 92 * 397 (2001 to 2100) of them."""
    parts = F.split(m, "[-/.]")
    sign, first = F.regexp_extract(m, "[-/.]", 0), F.length(parts[0]) == 4
    a, b = parts[0].cast("int"), parts[1].cast("int")
    day_first = ~first & ((sign == ".") | (a > 12))
    year = F.when(first, a).otherwise(parts[2].cast("int"))
    month = F.when(first | day_first, b).otherwise(a)
    day = F.when(first, parts[2].cast("int")).when(day_first, a).otherwise(b)
    when = F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day))      # null where there is no such day

    def permuted(when: Column, start: str, low: int, high: int) -> Column:
        n = F.datediff(when, F.lit(start).cast("date"))
        got = feistel(F.floor(n / high), n % high, low, high, key, "date" + start)
        return F.date_add(F.lit(start).cast("date"), let(got, lambda x: x["l"] * high + x["r"]).cast("int"))

    def written(new: Column) -> Column:
        pad = lambda x, old: F.when(F.length(old) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
        y, mo, d = F.year(new).cast("string"), F.month(new), F.dayofmonth(new)
        return (F.when(new.isNull(), None).when(first, F.concat(y, sign, pad(mo, parts[1]), sign, pad(d, parts[2])))
                .when(day_first, F.concat(pad(d, parts[0]), sign, pad(mo, parts[1]), sign, y))
                .otherwise(F.concat(pad(mo, parts[0]), sign, pad(d, parts[1]), sign, y)))

    century = lambda x: (F.when(F.year(x).between(1901, 2000), permuted(x, "1901-01-01", 75, 487))
                         .when(F.year(x).between(2001, 2100), permuted(x, "2001-01-01", 92, 397)))
    return let(let(when, century), written)


def mod97(value: Column) -> Column:
    """A string of digits and capitals (A = 10 ... Z = 35) as a number, modulo 97."""
    digit = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(value, ""), F.lit(0), lambda s, c: F.pmod(s * F.when(c.between("0", "9"), 10).otherwise(100) + digit(c), F.lit(97)))


def iban_right(chars: Column) -> Column:
    return mod97(F.concat(F.substr(chars, F.lit(5)), chars.substr(1, 4))) == 1


def iban(m: Column, key: str) -> Column:
    chars = keep(m, " ")
    country, rest = chars.substr(1, 2), F.substr(chars, F.lit(5))
    check = lambda x: F.lpad((98 - mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0")
    new = let(feistel_text(rest, key, "iban"), lambda x: F.concat(country, check(x), x))
    return F.when(iban_right(chars), let(new, lambda x: laid_over(m, x, " ")))


def email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(feistel_text(F.substr(m, F.lit(1), at - 1), key, "email"), F.substr(m, at))


def kind_of(m: Column) -> Column:
    """The pattern that a match belongs to (they are told apart by their form)."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (F.when(F.contains(m, F.lit("@")), "email").when(whole(IP), "ip").when(whole(DATE_YMD) | whole(DATE_DMY), "date")
            .when(whole(PHONE), "phone").when(whole(SSN), "ssn").when(whole(IBAN), "iban").otherwise("card"))


def part(kind: Column, text: Column) -> Column:
    return F.struct(kind.alias("kind"), text.alias("text"))


def labelled(text: Column, pattern: str, use) -> Column:
    """A text in parts, struct(kind, text): its gaps (of no kind) and use(match), an array of parts, of each match."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), use)
    gap = lambda g: F.array(part(F.lit(""), g))
    return let(found, lambda d: F.flatten(F.transform(F.split(text, pattern, -1), lambda g, i: F.when(i < F.size(d), F.concat(gap(g), F.get(d, i))).otherwise(gap(g)))))


def card_parts(m: Column) -> Column:
    """A row of digit groups in parts, struct(kind, text). From each group on, a valid card in a usual grouping is
    taken, else the longest valid one of whole groups that doesn't run into a usual one."""

    def parts(groups: Column, seps: Column) -> Column:
        span = lambda i, n: F.array_join(F.transform(F.slice(groups, i + 1, n), lambda g, k: F.concat(
            g, F.when(k < n - 1, F.get(seps, i + k)).otherwise(""))), "")
        valid = lambda i: F.filter(F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - i)), lambda n: let(
            F.array_join(F.slice(groups, i + 1, n), ""), lambda d: F.when(F.length(d).between(13, 19), luhn(d) % 10 == 0).otherwise(False)))
        usual = lambda i, found: F.coalesce(F.array_max(F.filter(found, lambda n: span(i, n).rlike(f"^(?:{USUAL})$"))), F.lit(0))
        at = F.transform(groups, lambda g, i: let(valid(i), lambda found: F.struct(
            usual(i, found).alias("usual"), F.coalesce(F.array_max(found), F.lit(0)).alias("any"))))

        def walk(at: Column) -> Column:
            """The cards as (first group, groups), by one pass that carries no text; then the gaps between them."""
            def size(a: Column, i: Column) -> Column:
                free = ~F.exists(F.slice(at, i + 2, F.greatest(a["any"] - 1, F.lit(0))), lambda x: x["usual"] > 0)
                return F.when(a["usual"] > 0, a["usual"]).when((a["any"] > 0) & free, a["any"]).otherwise(0)

            return let(F.transform(at, size), lambda sizes: let(chosen(sizes), laid_out))

        def chosen(sizes: Column) -> Column:
            start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<i:int,n:int>>").alias("taken"))

            def step(s: Column, i: Column) -> Column:
                # nothing here goes through `let`: a transform copies what it gives back
                n = F.get(sizes, i)
                take = F.struct((i + n).alias("next"), F.concat(s["taken"], F.array(F.struct(i.alias("i"), n.alias("n")))).alias("taken"))
                return F.when((i < s["next"]) | (n == 0), s).otherwise(take)

            return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda s: s["taken"])

        def gap(low: Column, high: Column) -> Column:
            """The text from behind group low - 1 up to group high, separators included."""
            lead = F.when(low > 0, F.coalesce(F.get(seps, low - 1), F.lit(""))).otherwise("")
            inside = F.transform(F.slice(groups, low + 1, high - low), lambda g, k: F.concat(g, F.coalesce(F.get(seps, low + k), F.lit(""))))
            return part(F.lit(""), F.concat(lead, F.array_join(inside, "")))

        def laid_out(taken: Column) -> Column:
            end = lambda j: F.when(j > 0, let(F.get(taken, j - 1), lambda t: t["i"] + t["n"])).otherwise(0)
            cards = F.flatten(F.transform(taken, lambda t, j: F.array(gap(end(j), t["i"]), part(F.lit("card"), span(t["i"], t["n"])))))
            return F.concat(cards, F.array(gap(end(F.size(taken)), F.size(groups))))

        return let(at, walk)

    return let(F.regexp_extract_all(m, F.lit("[0-9]+"), 0), lambda g: let(F.regexp_extract_all(m, F.lit("[^0-9]"), 0), lambda s: parts(g, s)))


def parts_of(text: Column) -> Column:
    """A text in parts, struct(kind, text); kinds are of form, validation is to come."""
    single = lambda m: F.array(part(kind_of(m), m))
    cards = lambda m: F.flatten(F.transform(card_parts(m), lambda p: F.when(p["kind"] == "card", F.array(p)).otherwise(labelled(p["text"], OTHERS, single))))
    again = lambda m, kind: (kind == "card") | (kind == "iban") & ~let(keep(m, " "), iban_right)
    return labelled(text, ANY, lambda m: let(kind_of(m), lambda kind: F.when(again(m, kind), labelled(m, CARDS, cards)).otherwise(F.array(part(kind, m)))))


def replacement(p: Column, key: str) -> Column:
    """struct(kind, new) of a part: new is null where there is no kind or validation fails."""
    by = {"email": email, "ip": ip, "date": date, "phone": phone, "ssn": ssn, "iban": iban, "card": card}
    kind, m = p["kind"], p["text"]
    new = F.when(kind == KINDS[0], by[KINDS[0]](m, key))
    for name in KINDS[1:]:
        new = new.when(kind == name, by[name](m, key))
    return F.struct(kind.alias("kind"), new.alias("new"))


def pseudonymise(docs: DataFrame, key: str = KEY, found: str = "pii_found") -> DataFrame:
    """`docs` with personal data in `text` replaced, and a column `found`: the kinds replaced, in order."""
    text = F.col("text")
    out = docs.withColumn("__pii_part", F.when(text.rlike("[0-9@]"), parts_of(text)).otherwise(F.array().cast("array<struct<kind:string,text:string>>")))
    out = out.withColumn("__pii_done", F.transform("__pii_part", lambda p: replacement(p, key)))
    joined = F.array_join(F.transform("__pii_part", lambda p, i: F.coalesce(F.get(F.col("__pii_done"), i)["new"], p["text"])), "")
    kinds = F.transform(F.filter("__pii_done", lambda x: x["new"].isNotNull()), lambda x: x["kind"])
    return out.withColumns({"text": F.when(F.size("__pii_part") > 1, joined).otherwise(text), found: kinds}).drop("__pii_part", "__pii_done")


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda name: F.size(F.filter("pii_found", lambda k: k == name)).alias(f"n_{name}")
    return got.select("doc_id", "text", *map(count, KINDS))
