r"""Secret scans: candidates by pattern, false positives removed by a random forest.

Everything on the documents is a DataFrame or SQL expression.  A candidate is a run of at least
16 token characters with a digit in it, or a shorter value assigned to a secret-like name (``name = value``, quoted
or not, ``Bearer value``).  A name and its sign aren't part of the value.
Each candidate gets the features of ``FEATURES``: length, character classes and the
transitions between them, coverage by dictionary words, path-like shape and surroundings, and
neighbouring words on both sides.  A random forest (fixed seed) votes; its trees become one SQL
expression, so scoring needs no shuffle and no second pass: a row's candidates are scored inside
the row.  Findings are cut into candidates by the same expression before they are learned from.  Only the fitting is Python, on the driver, from the features of at most ``MAX_FINDINGS`` labelled findings.

Labelled findings are a parameter (``left``, ``value``, ``right``, ``label``).  The given tables label no
findings, so ``labelled_findings`` generates a bounded set (``FINDINGS``) by rules for what
credentials and their usual look-alikes (commit ids, checksums, UUIDs, paths, phone numbers, long
words, placeholders) look like.

Defined cases: null text gives no candidates and stays null, empty text too; copies and repeated candidates
are each judged by their own neighbours; an empty table gives an empty result; other
columns pass through :func:`redact` untouched, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm.common import row_columns, shared_table, whole_rows

MARK = "[SECRET]"
THRESHOLD = 0.5
FINDINGS = 4_000
MAX_FINDINGS = 20_000
TREES = 20
DEPTH = 7
SEED = 11
LEFT_CHARS, RIGHT_CHARS = 40, 20

_TOKEN = "A-Za-z0-9_+/~-"  # and up to two '=' at the end
_NAMES = r"api[_\s-]?key|access[_\s-]?key|secret|token|password|passwd|pwd|credential|auth|authorization|bearer|private[_\s-]?key"
_BENIGN = "commit|sha-?1|sha-?256|md5|checksum|digest|uuid|guid|hash|build|revision|etag|isbn|phone|tel|call|version|license|example|sample|page|file|path|see"
_OPEN = r"[\s\"'`\\]"
_ASSIGNED = rf"[=:]{{1,2}}>?{_OPEN}{{0,4}}"
_SCHEME = r"(?i:bearer|basic|token)\s{1,2}"
_VALUE = r"[^\s\"'<>,;]"
_END = r"(?=[\s\"'<>,;]|\z|&\w{1,40}=|[.:)\]}`\\]{1,8}(?:[\s\"'<>,;]|\z))"
_DIGIT = r"(?=[A-Za-z_+/~-]*[0-9])"
# the assigned value first, so that a value isn't cut at its first other character; the first
# lookbehinds are the cheap ones: few places follow an assignment sign
CANDIDATE = (rf"(?<=[=:>\s\"'`\\])(?![=:>`\\])(?:(?<={_ASSIGNED}(?:{_SCHEME})?)(?<=(?i:{_NAMES})s?[\s\"'`\\-]{{0,4}}{_ASSIGNED}(?:{_SCHEME})?)"
             rf"|(?<=(?i:bearer)\s{{1,2}})(?=[a-z]*[^a-z\s\"'<>,;.])){_VALUE}{{8,}}?{_END}"
             # after the '=' of a run of 16
             rf"|(?<==)(?<=(?<![={_TOKEN}])(?=[={_TOKEN}]{{16}})[={_TOKEN}]{{1,200}}=){_DIGIT}[{_TOKEN}]{{8,}}(?:={{1,2}}(?![={_TOKEN}]))?"
             rf"|(?<![{_TOKEN}]){_DIGIT}[{_TOKEN}]{{16,}}(?:={{1,2}}(?![={_TOKEN}]))?")

# fixed values: words that names, paths and placeholders are made of
DICTIONARY = (
    "about access account action admin album alpha archive article asset author backup basic batch blog board book branch browser build button cache "
    "calendar category chapter chart client cloud code color comment commit common config contact container content context control copy core country "
    "create customer data date default delete demo design detail dev device digital document domain download draft dummy edit editor email empty english "
    "entry error event example export extra field file filter final first folder font footer form format forum frame function gallery general global "
    "group guide header hello help history home host html icon image import index info input install internal issue item java javascript language large layout library "
    "license light link list local login main manual master media member memory menu message method mobile model module month music name network news "
    "node note number object office online open option order output owner package page paper parent part path photo placeholder player plugin point policy "
    "post preview price print private process product profile project public python query question random record release remote report request resource response "
    "result review root sample schema school score script search section select server service session setting share shop show simple site size small source "
    "special sport standard start state static status store story street string style subject summary support system table target team template test text theme "
    "thread ticket time title topic train travel tree type update upload user value version video view web week widget window word work world year"
).split()

KNOWN = "AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|sk_live_|sk-|rk_live_|xox[abprs]-|AIza|eyJ|npm_|SG[.]"


def _classes(value: str) -> str:
    """A string with one letter per character class."""
    return (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({value}, '[^A-Za-z0-9]', '~'), '[a-z]', 'a'), "
            "'[A-Z]', 'A'), '[0-9]', '0')")


def _q(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\u0027") + "'"


def _count(value: str, pattern: str) -> str:
    return f"(length({value}) - length(regexp_replace({value}, {_q(pattern)}, '')))"


_QUOTE = "[\"'`]"
_ASSIGN = r"[=:]\s{0,3}" + _QUOTE + "?$"

# name -> SQL over c.value, c.before (text left of it), c.after
FEATURES = {
    "length": "length(c.value)",
    "transitions": f"(length(regexp_replace({_classes('c.value')}, '(.)\\\\1*', 'x')) - 1) / greatest(length(c.value) - 1, 1)",
    "digits": f"{_count('c.value', '[0-9]')} / length(c.value)",
    "upper": f"{_count('c.value', '[A-Z]')} / length(c.value)",
    "symbols": f"{_count('c.value', '[^A-Za-z0-9]')} / length(c.value)",
    "distinct": "size(array_distinct(split(c.value, ''))) / length(c.value)",
    "hex": "if(c.value rlike '^[0-9a-fA-F]+$', 1, 0)",
    "uuid": "if(c.value rlike '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$', 1, 0)",
    "numeric": "if(c.value rlike '^[0-9_+/=~-]+$', 1, 0)",
    "known": f"if(c.value rlike '^({KNOWN})', 1, 0)",
    "dictionary": f"{_count('c.value', '(?i)(' + '|'.join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ')')} / length(c.value)",
    "slashes": f"{_count('c.value', '/')}",
    "in_path": r"if(c.before rlike r'(://|[/.@?&#])$' or c.after rlike r'^[/?&#@]|^[.][A-Za-z]', 1, 0)",
    "assigned": f"if(c.before rlike {_q(_ASSIGN)}, 1, 0)",
    "quoted": f"if(c.before rlike {_q(_QUOTE + '$')} and c.after rlike {_q('^' + _QUOTE)}, 1, 0)",
    "named": f"if(c.before rlike r'(?i)({_NAMES})\\W{{0,6}}$', 1, 0)",
    "near_name": f"if(c.before rlike r'(?i)\\b({_NAMES})\\b', 1, 0)",
    "near_benign": f"if(concat(c.before, ' ', c.after) rlike r'(?i)\\b({_BENIGN})\\b', 1, 0)",
}


def candidates(text: Column, gaps: Column) -> Column:
    """Array of (value, before, after) of a text, in order; ``gaps``: the text between candidates."""
    values = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))

    def one(value: Column, i: Column) -> Column:
        left, right = F.get(gaps, i), F.get(gaps, i + 1)
        return F.struct(value.alias("value"), F.right(left, F.lit(LEFT_CHARS)).alias("before"),
                        F.left(right, F.lit(RIGHT_CHARS)).alias("after"))

    return F.transform(values, one)


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """(left, value, right, label): generated by rule, half credentials, half look-alikes."""
    rows = spark.range(n).select(
        F.col("id"), (F.col("id") % 2).cast("int").alias("label"), (F.floor(F.col("id") / 2) % 12).alias("kind"),
        F.sha2(F.col("id").cast("string"), 256).alias("h"), F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), F.col("id").cast("string")), 256))).alias("b"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("r"))
    word = [F.element_at(F.array(*map(F.lit, DICTIONARY)), (1 + F.pmod(F.xxhash64("id", F.lit(i)), F.lit(len(DICTIONARY)))).cast("int")) for i in range(6)]
    names = F.array(*map(F.lit, ["token", "secret", "password", "api_key", "access_key", "auth_token", "TOKEN", "client_secret", "private_key", "credential"]))
    name = F.element_at(names, (1 + F.col("r") % 10).cast("int"))
    sign = F.element_at(F.array(*map(F.lit, [' = "', "=", ": ", ': "', " = '", '":"'])), (1 + F.floor(F.col("r") / 10) % 6).cast("int"))
    close = F.when(sign.endswith('"'), '"').when(sign.endswith("'"), "'").otherwise("")
    plain_left = F.concat(word[0], F.lit(" "), word[1], F.lit(" "))
    key_left = F.concat(word[0], F.lit(" "), name, sign)
    hex40, b64 = F.substr("h", F.lit(1), F.lit(40)), F.regexp_replace("b", "=", "")
    size = (20 + F.col("r") % 24).cast("int")
    shouted = F.when(F.col("r") % 3 == 0, F.upper(hex40)).otherwise(hex40)
    k, empty = F.col("kind"), F.lit("")

    def choose(*by_kind):
        out = by_kind[-1]
        for i in range(len(by_kind) - 2, -1, -1):
            out = F.when(k == i, by_kind[i]).otherwise(out)
        return out

    secret_value = choose(shouted, shouted, F.substr("h", F.lit(1), F.lit(32)), F.substr(b64, F.lit(1), size), F.substr(b64, F.lit(1), size), F.col("h"),
                          F.concat(F.lit("AKIA"), F.upper(F.substr("h", F.lit(1), F.lit(16)))), F.concat(F.lit("ghp_"), F.regexp_replace(F.substr(b64, F.lit(1), F.lit(36)), "[+/]", "x")),
                          F.concat(F.lit("sk_live_"), F.regexp_replace(F.substr(b64, F.lit(1), F.lit(24)), "[+/]", "y")),
                          F.concat(F.lit("xoxb-"), F.conv(F.substr("h", F.lit(1), F.lit(10)), 16, 10), F.lit("-"), F.substr(b64, F.lit(1), F.lit(24))),
                          F.concat(word[2], F.col("r").cast("string"), F.lit("!"), F.substr(b64, F.lit(1), F.lit(6))), F.concat(F.lit("eyJ"), F.col("b")))
    secret_left = choose(*([key_left] * 6 + [F.when(F.col("r") % 2 == 0, key_left).otherwise(plain_left)] * 4 + [key_left] * 2))
    harmless_value = choose(hex40, hex40, F.substr("h", F.lit(1), F.lit(32)), F.col("h"),
                            F.regexp_replace(F.substr("h", F.lit(1), F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
                            F.concat_ws("/", word[1], word[2], word[3], F.concat(word[4], F.col("r").cast("string"))),
                            F.concat_ws("-", word[1], word[2], word[3], F.col("r").cast("string")), F.concat_ws("_", word[1], word[2], F.col("r").cast("string"), word[4]),
                            F.concat(F.lit("+49-"), F.regexp_replace(F.substr(F.conv(F.substr("h", F.lit(1), F.lit(12)), 16, 10), F.lit(1), F.lit(12)), "^(.{3})(.{4})(.*)$", "$1-$2-$3")),
                            F.rpad(F.concat(F.lit("your_"), name, F.lit("_1")), 24, "x"), F.rpad(F.lit("1234567890"), 24, "1234567890"),
                            F.concat(word[1], word[2], word[3], word[4], F.lit("2")))
    benign = [F.lit(x) for x in ("commit ", "sha1: ", "md5 checksum ", "sha256:", "uuid=", "see /", "page ", "file ", "call ")]
    harmless_left = choose(*[F.concat(plain_left, x) for x in benign], key_left, F.concat(plain_left, F.lit("id ")), key_left)
    # half of the look-alikes stand in plain text
    harmless_left = F.when((F.floor(F.col("r") / 7) % 2 == 0) & ~k.isin(9, 11), plain_left).otherwise(harmless_left)
    return rows.select(
        F.when(F.col("label") == 1, secret_left).otherwise(harmless_left).alias("left"),
        F.when(F.col("label") == 1, secret_value).otherwise(harmless_value).alias("value"),
        F.concat(F.when((F.col("label") == 1) & (secret_left == key_left), close).otherwise(empty), F.lit(" "), word[5], F.lit(" ")).alias("right"), "label")


def found_candidates(findings: DataFrame) -> DataFrame:
    """(c, label): the candidates that the scan makes of the findings' values."""
    body = findings.select("value", F.col("label").cast("int").alias("label"), F.concat("left", "value", "right").alias("text")).na.drop()
    return (body.select("value", "label", F.explode(candidates(F.col("text"), F.split("text", CANDIDATE, -1))).alias("c"))
            .filter(F.contains("value", F.col("c.value")) | F.contains(F.col("c.value"), F.col("value"))).select("c", "label"))


def fit_forest(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED, most: int = MAX_FINDINGS) -> str:
    """The fitted forest as SQL over the features of a struct ``f`` (share of trees that vote secret).

    At most about ``most`` findings (a hash sample) come to the driver, as numbers.  A finding is learned as the candidates
    that the scan would make of its value; one without any is never scored."""
    # written in steps: as one plan, the generator, the scan and the features are too large to compile, which
    # costs the driver hundreds of megabytes
    rows = shared_table(found_candidates(shared_table(findings, "secret-findings")), "secret-candidates")
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64("c"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    data = np.array([tuple(r) for r in rows.select("label", *[F.expr(f"cast({x} as double)").alias(k) for k, x in FEATURES.items()])
                     .orderBy("label", *FEATURES).collect()]).reshape(-1, len(FEATURES) + 1)
    rng = np.random.RandomState(seed)
    grown = []
    for _ in range(trees):
        drawn = data[rng.randint(0, len(data), len(data))] if len(data) else data
        grown.append(tree_sql(grow(drawn[:, 1:], drawn[:, 0], depth, rng)))
    return "(" + " + ".join(grown) + f") / {float(trees)}"


def grow(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.RandomState):
    """A tree as nested (feature, limit, left, right); a leaf is its vote.  Every node tries a random
    share of the features and takes the cut with the least Gini impurity."""
    share = y.mean() if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return float(share >= 0.5)
    best = None
    for k in rng.choice(x.shape[1], max(1, x.shape[1] // 3), replace=False):
        by = np.argsort(x[:, k], kind="stable")
        v, ones = x[by, k], np.cumsum(y[by])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        n, total = cut + 1.0, len(y)
        p, q = ones[cut] / n, (ones[-1] - ones[cut]) / (total - n)
        impurity = n * p * (1 - p) + (total - n) * q * (1 - q)
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0]:
            best = (impurity[i], k, (v[cut[i]] + v[cut[i] + 1]) / 2)
    if best is None:
        return float(share >= 0.5)
    left = x[:, best[1]] <= best[2]
    return int(best[1]), float(best[2]), grow(x[left], y[left], depth - 1, rng), grow(x[~left], y[~left], depth - 1, rng)


def tree_sql(tree) -> str:
    """CASE expression of a tree of :func:`grow`."""
    if isinstance(tree, float):
        return f"{tree}D"
    feature, limit, left, right = tree
    return f"CASE WHEN f.{list(FEATURES)[feature]} <= {limit!r}D THEN {tree_sql(left)} ELSE {tree_sql(right)} END"


def scan(docs: DataFrame, findings: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``_gaps`` (text between candidates) and ``_found``: (value, score) per candidate."""
    forest = fit_forest(labelled_findings(docs.sparkSession) if findings is None else findings)
    fields = ", ".join(f"'{k}', cast({x} as double)" for k, x in FEATURES.items())
    body = F.col(f"`{text}`").cast("string")
    return (docs.withColumn("_gaps", F.split(body, CANDIDATE, -1)).withColumn("_found", candidates(body, F.col("_gaps")))
            .withColumn("_found", F.expr(f"transform(_found, c -> struct(c.value as value, named_struct({fields}) as f))"))
            .withColumn("_found", F.expr(f"transform(transform(_found, x -> struct(x.value as value, x.f as f)), x -> struct(x.value as value, "
                                         f"{re.sub(r'(?<![A-Za-z_.])f[.]', 'x.f.', forest)} as score))")))


def redacted(threshold: float = THRESHOLD) -> Column:
    """The text with every secret replaced by MARK, from the columns of :func:`scan`."""
    return F.expr(f"""CASE WHEN _gaps IS NULL THEN NULL ELSE array_join(transform(_gaps, (g, i) -> concat(g, CASE
        WHEN i >= size(_found) THEN '' WHEN get(_found, i).score >= {threshold} THEN '{MARK}' ELSE get(_found, i).value END)), '') END""")


def redact(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked; columns as before."""
    rows = whole_rows(docs)
    return scan(rows.withColumn("text", rows["row"].getField("text")), findings).select(*row_columns(docs.columns, text=redacted()))


def report(docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """doc_id, n_candidates, n_secrets, secret_sha256 (list), redacted_chars, redacted_sha256 per document."""
    rows = scan(docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col("`text`").cast("string").alias("text")), findings)
    hits = F.filter("_found", lambda x: x["score"] >= THRESHOLD)
    return (rows.withColumn("_clean", F.coalesce(redacted(), F.lit("")))
            .select("doc_id", F.coalesce(F.size("_found"), F.lit(0)).cast("bigint").alias("n_candidates"),
                    F.coalesce(F.size(hits), F.lit(0)).cast("bigint").alias("n_secrets"),
                    F.coalesce(F.transform(hits, lambda x: F.sha2(x["value"].cast("binary"), 256)), F.array().cast("array<string>")).alias("secret_sha256"),
                    F.length("_clean").cast("bigint").alias("redacted_chars"), F.sha2(F.col("_clean").cast("binary"), 256).alias("redacted_sha256")))
