"""Secret scan with multipart linking: strong findings stand alone, weak ones only beside a complement.

Base findings are assignments, access identifiers and long hex runs. Weak
candidates (account names, short, labelled or unlabelled secrets, endpoints) are matched
with the other parts of the same text by an interval join: parts are dealt to
scope buckets along the text, equal buckets meet, and a weak candidate is
reported if a part of a complementary role lies within the scope. The join is
a semi join, so no pairs are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_key

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA[A-Z0-9]+ of 16 or more characters: the run is taken whole either way
HEX = r"[0-9a-f]{32,}"  # [0-9a-f]+ of 32 or more characters

# Weak candidates. A label may stand behind an underscore (DB_USER) and end in a further part or number (user_id, pwd2).
FRONT, NUMBER, IS = r"(?<![A-Za-z0-9])", r"(?:[_-]?[0-9]{1,4})?", r"""["']?\x20*[:=]\x20*["']?"""
WEAK_ID = (rf"""(?i){FRONT}(?:user(?:name)?|login|e-?mail|account|client[_-]?id|(?<!secret[_-])access[_-]?key(?:[_-]?id)?)"""
           rf"""(?:[_-]?(?:name|id|email))?{NUMBER}{IS}[a-z0-9_.@+-]{{3,}}""")
WEAK_SECRET = (rf"""(?i){FRONT}(?:(?:pwd|pass|credentials?|auth(?:orization)?|bearer|signature|private[_-]?key|"""
               rf"""account[_-]?key|secret[_-]?(?:access[_-]?)?key)(?:[_-]?(?:key|value|code|phrase|string|hash))?{NUMBER}{IS}"""
               r"""(?:(?:bearer|basic|token)\x20+)?[a-z0-9+/_.=~-]{4,}|"""
               r"""bearer\x20+(?:(?=[a-z+/_.=~-]*[0-9])[a-z0-9+/_.=~-]{8,}|[a-z0-9+/_.=~-]{20,})|"""
               # Without a sign in between, as people write it: something with a digit.
               rf"""{FRONT}(?:passw(?:or)?d|passphrase|pwd)\x20+(?:is\x20+)?(?=[!-/;-~]{{0,64}}[0-9])[!-9;<>-~]{{4,64}})""")
# A private key block.
BLOCK = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=,:\s-]{16,}?-----END [A-Z ]{0,30}PRIVATE KEY-----"
# The three parts of scheme://user:password@host.
URI_USER, URI_WORD = "[!-~&&[^:/@\"'<>]]{1,100}", "[!-~&&[^/@\"'<>]]{1,200}"
URI_ID = rf"(?<=://){URI_USER}(?=:{URI_WORD}@[A-Za-z0-9])"
URI_SECRET = rf"(?<=://{URI_USER}:){URI_WORD}(?=@[A-Za-z0-9])"
URI_HOST = rf"(?<=://{URI_USER}:{URI_WORD}@)[A-Za-z0-9][A-Za-z0-9.-]{{0,253}}(?::[0-9]{{1,5}})?"
# Unlabelled: a base64 run of 32 or more characters with lower case, upper case and digits, a hex run of 24 or more
# with letters and digits, or a token that begins as those of a known issuer do.
BARE = (r"""(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[0-9])"""
        r"""[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])|"""
        r"""(?<![A-Za-z0-9])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])(?:[0-9a-f]{24,}|[0-9A-F]{24,})(?![A-Za-z0-9])|"""
        r"""(?<![A-Za-z0-9_-])(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}""")
ENDPOINT = (r"""(?i)\bhttps?://[^\s"'<>]+|\b(?:\d{1,3}\.){3}\d{1,3}\b(?::\d{1,5})?|"""
            r"""\b[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)+:\d{2,5}\b""")

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint", "bare_secret")
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret",
        "endpoint": "endpoint", "bare_secret": "secret"}
# Code points between two parts of one credential.
SCOPE = 200

SPAN = "struct<start:int,kind:int,end:int>"


def spans_of(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """Struct (start, kind, end) of each leftmost non-overlapping match whose group has ``least`` characters.

    Offsets come from the lengths of the pieces between the matches. Patterns
    that match nothing but ASCII never cut a code point.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.length(v))
    steps = F.zip_with(F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("piece"), found.alias("match")), sizes,
                       lambda a, n: F.struct(F.length(a["piece"]).alias("gap"), F.length(a["match"]).alias("n"),
                                             n.alias("value")))
    empty = F.array().cast(f"array<{SPAN}>")
    return F.aggregate(
        steps, F.struct(F.lit(0).alias("pos"), empty.alias("out")),
        lambda acc, s: F.struct(
            (acc["pos"] + s["gap"] + s["n"]).alias("pos"),
            F.when(s["value"] >= least, F.concat(acc["out"], F.array(F.struct(
                (acc["pos"] + s["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (acc["pos"] + s["gap"] + s["n"]).alias("end"))))).otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])


def find_parts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, text_key, base, weak): base findings and weak candidates of each row as sorted spans."""
    empty = F.array().cast(f"array<{SPAN}>")
    own = docs.select(F.col(key).alias("_key"), text_key(F.col(text)).alias("_text"),
                      F.coalesce(F.col(text), F.lit("")).alias("_t"))
    own = own.withColumn("_low", F.lower("_t"))

    def has(*parts: str) -> Column:
        """A cheap test that every match passes."""
        test = F.lit(False)
        for p in parts:
            test = test | F.contains(F.col("_low"), F.lit(p))
        return test

    def only(test: Column, found: Column) -> Column:
        return F.when(test, found).otherwise(empty)

    t = F.col("_t")
    base = F.concat(only(has("passw", "secret", "token", "apikey", "api_key"), spans_of(t, ASSIGN, 0, 8, 2)),
                    only(F.contains(t, F.lit("AKIA")), spans_of(t, ACCESS, 1)),
                    only(t.rlike(HEX), spans_of(t, HEX, 2)))
    short = F.filter(spans_of(t, ASSIGN, 4, 0, 2), lambda s: ~F.exists("_base", lambda b: b["start"] == s["start"]))
    uri = F.contains(t, F.lit("://")) & F.contains(t, F.lit("@"))
    weak = F.concat(only(has("user", "login", "mail", "account", "client", "access"), spans_of(t, WEAK_ID, 3)),
                    only(uri, spans_of(t, URI_ID, 3)), only(uri, spans_of(t, URI_SECRET, 4)), only(uri, spans_of(t, URI_HOST, 5)),
                    only(has("private key-----"), spans_of(t, BLOCK, 4)),
                    only(has("pwd", "pass", "credential", "auth", "bearer", "signature", "private", "secret", "account"),
                         spans_of(t, WEAK_SECRET, 4)),
                    only(has("passw", "secret", "token", "apikey", "api_key"), short),
                    only(t.rlike(r"\d\.\d|://|[A-Za-z0-9]:\d\d"), spans_of(t, ENDPOINT, 5)))
    bare = only(t.rlike("[A-Za-z0-9+/_-]{20}"), spans_of(t, BARE, 6))

    def apart(found: Column, taken: Column) -> Column:
        return F.filter(found, lambda w: ~F.exists(taken, lambda b: (w["start"] < b["end"]) & (b["start"] < w["end"])))
    # An unlabelled run that a labelled part holds is that part.
    labelled = F.concat("_base", F.filter("_weak", lambda w: w["kind"] != 5))
    return (own.withColumn("_base", F.array_sort(base))
            .withColumn("_weak", apart(weak, F.col("_base")))
            .withColumn("_weak", F.array_sort(F.array_distinct(F.concat("_weak", apart(bare, labelled)))))
            .select("_key", "_text", "_base", "_weak"))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Rows (_key, _text, _linked): the weak candidates that have a complementary part within ``scope``.

    An account name needs a secret, a secret an account name or an endpoint, an
    endpoint a secret or an access identifier. An unlabelled secret and a part
    that overlaps it say nothing about each other.
    """
    roles = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (i, ROLE[k])])
    flat = (parts.filter(F.size("_weak") > 0).select("_key", "_text", F.explode("_weak").alias("w"))
            .select("_key", "_text", F.col("w.start").alias("start"), F.col("w.kind").alias("kind"),
                    F.col("w.end").alias("end")))
    other = (parts.filter(F.size("_weak") > 0)
             .select("_key", "_text", F.explode(F.concat("_base", "_weak")).alias("p"))
             .select(F.col("_key").alias("p_key"), F.col("_text").alias("p_text"), F.col("p.start").alias("p_start"),
                     F.col("p.end").alias("p_end"), F.col("p.kind").alias("p_kind"),
                     roles[F.col("p.kind")].alias("p_role")))
    bucket = lambda c: F.floor(c / scope).cast("int")
    # Both sides stand in every bucket they touch, a weak part with its scope around it: parts in reach always meet.
    left = flat.withColumn("role", roles[F.col("kind")]).withColumn("bucket", F.explode(F.sequence(
        bucket(F.greatest(F.col("start") - scope, F.lit(0))), bucket(F.col("end") + scope))))
    right = other.withColumn("p_bucket", F.explode(F.sequence(bucket(F.col("p_start")), bucket(F.col("p_end")))))
    complement = (((F.col("role") == "id") & (F.col("p_role") == "secret"))
                  | ((F.col("role") == "secret") & F.col("p_role").isin("id", "endpoint"))
                  | ((F.col("role") == "endpoint") & ((F.col("p_role") == "secret") | (F.col("p_kind") == 1))))
    near = (F.col("p_start") <= F.col("end") + scope) & (F.col("p_end") >= F.col("start") - scope)
    bare = KINDS.index("bare_secret")
    near &= ((F.col("kind") != bare) & (F.col("p_kind") != bare)) | (F.col("p_start") >= F.col("end")) | (
        F.col("p_end") <= F.col("start"))
    met = left.join(right, F.col("_key").eqNullSafe(F.col("p_key")) & (F.col("_text") == F.col("p_text"))
                    & (F.col("bucket") == F.col("p_bucket")) & complement & near, "left_semi")
    return met.groupBy("_key", "_text").agg(F.collect_set(F.struct("start", "kind", "end")).alias("_linked"))


def scan_secrets(docs: DataFrame, scope: int = SCOPE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (key, text_key, base, linked, spans), spans sorted by start, then kind.

    Each span is (start, kind, end) in code points, end exclusive; ``kind`` is
    a position in ``KINDS``. Null and empty texts have none. Rows that repeat a
    key and text have equal results; a null key is a key like any other. An
    empty table gives an empty result.
    """
    parts = cut(find_parts(docs, key, text))
    linked = link_parts(parts, scope)
    linked = linked.select(F.col("_key").alias("l_key"), F.col("_text").alias("l_text"), "_linked")
    out = parts.join(linked, F.col("_key").eqNullSafe(F.col("l_key")) & (F.col("_text") == F.col("l_text")), "left")
    found = F.coalesce(F.col("_linked"), F.array().cast(f"array<{SPAN}>"))
    return out.select(F.col("_key").alias(key), F.col("_text").alias("text_key"), F.col("_base").alias("base"),
                      F.array_sort(found).alias("linked"), F.array_sort(F.concat("_base", found)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "[secret]", scope: int = SCOPE, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``docs`` with every reported span of its text replaced by ``mask``; overlapping spans count as one."""
    found = scan_secrets(docs, scope, key, text).filter(F.size("spans") > 0).select(
        F.col(key).alias("_s_key"), F.col("text_key").alias("_s_text"), F.col("spans").alias("_s_spans")
    ).dropDuplicates(["_s_key", "_s_text"])
    joined = docs.join(found, docs[key].eqNullSafe(found["_s_key"]) & (text_key(docs[text]) == found["_s_text"]), "left")
    t = F.col(text)
    clean = F.aggregate(
        "_s_spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["pos"], F.struct(
            s["end"].alias("pos"), F.concat(acc["out"], F.substring(t, acc["pos"] + 1, s["start"] - acc["pos"]),
                                            F.lit(mask)).alias("out")))
        .otherwise(F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["pos"] + 1, F.length(t))))
    return joined.withColumn(text, F.when(F.col("_s_spans").isNull(), t).otherwise(clean)).select(*docs.columns)
