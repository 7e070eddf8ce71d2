"""Secret scans: a random forest removes false positives among candidates.

Candidates are proposed in two ways. A value is anything of at least MIN_VALUE characters but quotes, blanks and the signs
, ; & ) that is given to a name that tells of secrets, in the same word (key=value, "key":"value", key=>value) or in the
next one (key: value, key = value), so passwords need neither length nor digits; a word has as many values as are given in
it. A run is one of at least MIN_LENGTH letters, digits and _ + / -, with closing = signs, outside the values and their
names, that isn't a plain word: it holds a digit, a capital after a small letter, or capitals alone. The forest does the
rest. Its features are the length, shares of digits and capitals, transitions between character classes, distinct
characters, the share of its letters in words of the dictionary, signs of a path, and the words near it: those that name
secrets and those that name digests, revisions and identifiers. Near are NEAR words on either side and what stands before
it in its own word, of each of them the nearest CONTEXT characters. The dictionary is a table of words: those in one of
DICTIONARY_SHARE documents, and words of paths.

The forest is trained by Spark's own learner on labelled findings (a table with the columns text and secret, one
finding to a text; labelled() makes the default one from rules with plain SQL functions, LABELLED rows). Its trees
become nested CASE expressions, so that a scan is one pass of built-in functions over the texts.

Edge cases: a null or empty text has no candidates; texts with neither a run nor a word that names secrets are skipped
after one look; words of any length are scanned, in time that grows with the length; repeated rows and repeated candidates
each get their own row, with the context of their own place; scores of THRESHOLD count as secrets; an empty table gives an
empty result; further columns, of any name, are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.shared import WORD_GAP, bounded, table, written

MIN_LENGTH, MIN_VALUE = 12, 6
#: A word of the dictionary stands in at least one of so many documents, and in two at least.
DICTIONARY_SHARE = 2_000
#: At most so many words of the dictionary, or distinct candidates' coverages, are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000
#: Words before and after a candidate that count as near, and characters of each.
NEAR, CONTEXT = 3, 80
LABELLED = 4_000
TREES, DEPTH, SEED = 15, 5, 11
THRESHOLD = 0.5

_RUN = rf"[A-Za-z0-9_+/\-]{{{MIN_LENGTH},}}={{0,2}}"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
SECRET_WORDS = "token|secret|passw|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential|signing"
BENIGN_WORDS = "commit|sha1|sha256|sha-|md5|checksum|digest|hash|uuid|guid|revision|\\brev\\b|integrity|etag|version|build|order|invoice|serial|isbn|card|phone|example|sample|blob|trace"
PATH_WORDS = "user|name|file|path|data|test|home|main|index|image|static|assets|config|service|default|version|component|module|public|package|library|master|release|update|server|client|button|header|footer|content|report|summary|number|chapter|section|figure|table|window|system|local|docs|node|java|python|http|www|html|json|list|item|page|view|model|size|type|time|date|week|year|month"
FEATURES = ["f_length", "f_digits", "f_upper", "f_hex", "f_transitions", "f_distinct", "f_dictionary", "f_path", "f_secret_words", "f_benign_words", "f_assigned"]


_SIGN = r"(?:=>|[:=])++"
#: A name that tells of secrets, its sign and its value; possessive steps keep long words from being read again and again.
_NAME = rf"(?<![a-z0-9_\-])(?=[a-z0-9_\-]*?(?:{SECRET_WORDS}))[a-z0-9_\-]++[\"']?"
_GIVEN = rf"([^\s\"',;&)]{{{MIN_VALUE},}})"
_VALUE = rf"(?i)({_NAME}{_SIGN}[\"'(]*+){_GIVEN}"
_FIRST_VALUE = rf"^([\"'(]*+){_GIVEN}"
_ASKS, _NAMED, _GIVES = rf"(?i){_NAME}{_SIGN}[\"'(]*+$", rf"(?i){_NAME}$", rf"^{_SIGN}$"
_NOT_A_WORD = r"[0-9]|[a-z][A-Z]|^[A-Z_+/\-]+=*$"
#: What a word or text holds that has such a run.
_MAY = r"[0-9]|[a-z][A-Z]|[A-Z]{4}"
_FOUND = "array<struct<candidate:string,own:string>>"


def _bound(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(word: Column, asked: Column) -> Column:
    """The candidates of a word, each with what stands before it; asked: the words before name a secret.

    The word is cut at blanks, which it can't hold itself, into what is between values, a name with its sign, a value,
    and so on in threes.
    """
    cut = lambda x: F.split(F.regexp_replace(x, _VALUE, " $1 $2 "), " ", -1)
    first = asked & word.rlike(_FIRST_VALUE)
    rest = cut(F.when(first, F.regexp_replace(word, _FIRST_VALUE, "")).otherwise(word))
    head = F.array(F.lit(""), F.regexp_extract(word, _FIRST_VALUE, 1), F.regexp_extract(word, _FIRST_VALUE, 2))
    parts = F.when(first, F.concat(head, rest)).otherwise(rest)
    near = lambda *x: F.right(F.concat(*x), F.lit(CONTEXT))
    part = lambda parts, k: F.coalesce(F.get(parts, k), F.lit(""))

    def runs(p: Column, before: Column) -> Column:
        def each(b: Column) -> Column:
            found = F.transform(b["r"], lambda x, j: F.struct(x.alias("candidate"), near(F.when(j == 0, before).otherwise(F.get(b["r"], j - 1)), F.get(b["g"], j)).alias("own")))
            return F.filter(found, lambda x: x["candidate"].rlike(_NOT_A_WORD))

        return _bound(F.struct(F.regexp_extract_all(p, F.lit(f"({_RUN})"), F.lit(1)).alias("r"), F.split(p, _RUN, -1).alias("g")), each)

    def whole(parts: Column) -> Column:
        def each(p: Column, m: Column) -> Column:
            before = near(part(parts, m - 2), part(parts, m - 1))
            return F.when(m % 3 == 2, F.array(F.struct(p.alias("candidate"), before.alias("own"))).cast(_FOUND)).when(m % 3 == 0, runs(p, before).cast(_FOUND)).otherwise(F.array().cast(_FOUND))

        return F.flatten(F.transform(parts, each))

    return _bound(parts, whole)


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns of docs, word (place of the word, from 1), piece (place in the word, from 0), candidate, before and after."""
    texts = docs.select(*keep, "text").where((F.col("text").rlike(_MAY) & F.col("text").rlike(_RUN)) | F.col("text").rlike(f"(?i)(?:{SECRET_WORDS})"))
    words = texts.select(*keep, F.split("text", WORD_GAP).alias("_w"))
    w = lambda i: F.coalesce(F.get(F.col("_w"), i), F.lit(""))
    asked = lambda i: w(i - 1).rlike(_ASKS) | (w(i - 1).rlike(_GIVES) & w(i - 2).rlike(_NAMED))
    each = F.transform("_w", lambda x, i: F.struct((i + 1).alias("word"), x.alias("x"), (asked(i) & ~x.rlike(_ASKS)).alias("asked")))
    found = F.filter(each, lambda s: (s["x"].rlike(_RUN) & s["x"].rlike(_MAY)) | s["asked"] | s["x"].rlike(_VALUE))
    rows = words.select(*keep, "_w", F.explode(found).alias("_f"))
    near = lambda a, n, side: F.array_join(F.transform(F.slice("_w", a, n), lambda x: side(x, F.lit(CONTEXT))), " ")
    at = F.col("_f.word")
    rows = rows.select(*keep, at.alias("word"), near(F.greatest(at - NEAR, F.lit(1)), F.least(at - 1, F.lit(NEAR)), F.right).alias("_b"), near(at + 1, F.lit(NEAR), F.left).alias("_a"), _found(F.col("_f.x"), F.col("_f.asked")).alias("_c"))
    rows = rows.select(*keep, "word", "_b", "_a", F.posexplode("_c").alias("piece", "_c"))
    return rows.select(*keep, "word", "piece", "_c.candidate", F.concat_ws(" ", "_b", "_c.own").alias("before"), F.col("_a").alias("after"))


def dictionary(docs: DataFrame | None, spark: SparkSession, share: int = DICTIONARY_SHARE) -> DataFrame:
    """entry: the words of the dictionary, from documents if there are any."""
    fixed = spark.range(1).select(F.explode(F.split(F.lit(PATH_WORDS), r"\|")).alias("entry"))
    if docs is None:
        return fixed
    own = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![a-z0-9_+/\-])([a-z]{3,20})(?![a-z0-9_+/\-])"), F.lit(1)))).alias("entry"))
    often = own.groupBy("entry").agg(F.count("*").alias("n")).where(F.col("n") >= max(2, -(-docs.count() // share)))
    return often.select("entry").union(fixed).distinct()


def covered(rows: DataFrame, entries: DataFrame, spark: SparkSession) -> DataFrame:
    """rows with _covered, the number of letters of the candidate that words of the dictionary make up."""
    rows = written(spark, rows, "candidates")
    parts = rows.select("candidate").distinct().select("candidate", F.explode(F.regexp_extract_all("candidate", F.lit("([A-Z]?[a-z]+|[A-Z]+)"), F.lit(1))).alias("part"))
    known = parts.join(bounded(entries, BROADCAST_ROWS), F.lower("part") == F.col("entry")).groupBy("candidate").agg(F.sum(F.length("part")).alias("_covered"))
    known = bounded(written(spark, known, "covered"), BROADCAST_ROWS)
    return rows.join(known, "candidate", "left").withColumn("_covered", F.coalesce("_covered", F.lit(0)))


def with_features(rows: DataFrame) -> DataFrame:
    """rows (columns candidate, before, after, _covered) with the features as doubles."""
    c = F.col("candidate")
    n = F.length(c).cast("double")
    classes = F.translate(c, _UPPER + _LOWER + _DIGITS + "_+/=-", "A" * 26 + "a" * 26 + "0" * 10 + "-" * 5)
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    share = lambda chars: (n - F.length(F.translate(c, chars, ""))) / n
    context = F.lower(F.concat_ws(" ", "before", "after"))
    return rows.withColumns({
        "f_length": F.least(n, F.lit(200.0)),
        "f_digits": share(_DIGITS),
        "f_upper": share(_UPPER),
        "f_hex": c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "f_transitions": (runs - 1) / F.greatest(n - 1, F.lit(1.0)),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "f_dictionary": F.col("_covered") / n,
        "f_path": (c.rlike("/[a-z_-]+/") | F.col("before").rlike(r"(?:https?:|/|\\.[a-z]{2,4}|@)$")).cast("double"),
        "f_secret_words": F.lower("before").rlike(SECRET_WORDS).cast("double"),
        "f_benign_words": context.rlike(BENIGN_WORDS).cast("double"),
        "f_assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
    })


def labelled(spark: SparkSession, rows: int = LABELLED) -> DataFrame:
    """text and secret (0 or 1): one finding to a text, made from digests of row numbers by fixed rules."""
    r = spark.range(0, rows, 1, 1).select("id", F.sha2(F.concat(F.lit("folio"), F.col("id").cast("string")), 512).alias("h"), F.pmod(F.hash("id"), F.lit(18)).alias("k"), F.pmod(F.xxhash64("id"), F.lit(6)).cast("int").alias("v"))
    b64 = F.translate(F.base64(F.unhex(F.substring("h", 1, 72))), "=", "")
    name = F.element_at(F.array(*map(F.lit, ("token", "api_key", "secret", "password", "auth_token", "client_secret"))), F.col("v") + 1)
    sign = F.element_at(F.array(*map(F.lit, (' = "', '="', ": ", "=", ": '", ' = "'))), F.col("v") + 1)
    shut = F.element_at(F.array(*map(F.lit, ('"', '"', "", "", "'", '"'))), F.col("v") + 1)
    hexa = lambda a, n: F.substring("h", a, n)
    digits = F.translate(F.substring("h", 3, 16), "abcdef", "123456")
    uuid = F.concat_ws("-", hexa(1, 8), hexa(9, 4), hexa(13, 4), hexa(17, 4), hexa(21, 12))
    noun = F.element_at(F.array(*map(F.lit, ("user", "image", "report", "config", "module", "chapter"))), F.col("v") + 1)
    lead = F.element_at(F.array(*map(F.lit, ("we saw", "and the", "of it", "then on", "all in", "from a"))), F.col("v") + 1)
    kinds = [
        (F.concat(lead, F.lit(" "), name, sign, hexa(1, 40), shut, F.lit(" of the rest")), 1),
        (F.concat(name, sign, F.substring(b64, 1, 32), shut), 1),
        (F.concat(lead, F.lit(" Authorization: Bearer "), b64), 1),
        (F.concat(name, sign, F.lit("AKIA"), F.upper(F.substring(b64, 1, 16)), F.lit("7"), shut), 1),
        (F.concat(name, sign, F.lit("sk_live_"), F.substring(b64, 1, 24), F.lit("9"), shut), 1),
        (F.concat(lead, F.lit(" "), name, sign, hexa(5, 32), shut), 1),
        (F.concat(name, sign, F.lit("AKIA"), F.translate(F.upper(F.substring(b64, 1, 12)), "0123456789+/", "QWERTZUIOPAS"), shut, F.lit(" was")), 1),
        (F.concat(lead, F.lit(" "), name, sign, F.substring(b64, 3, 5), F.lit("!"), F.substring(b64, 9, 4), F.lit("~"), shut), 1),
        (F.concat(lead, F.lit(" "), name, F.lit(": "), noun, F.lit(" of the rest")), 0),
        (F.concat(lead, F.lit(" "), noun, F.lit("Component"), F.upper(noun), F.lit("ListItem page")), 0),
        (F.concat(F.lit("commit "), hexa(1, 40), F.lit(" merged")), 0),
        (F.concat(F.lit("md5 checksum: "), hexa(1, 32)), 0),
        (F.concat(lead, F.lit(" id "), uuid, F.lit(" was")), 0),
        (F.concat(lead, F.lit(" /static/"), noun, F.lit("/version-"), hexa(1, 3), F.lit("/"), noun, F.lit("-index.html")), 0),
        (F.concat(lead, F.lit(" "), digits, F.lit(" and the rest")), 0),
        (F.concat(lead, F.lit(" "), noun, F.lit("_component_default_"), hexa(1, 2), F.lit("7 name")), 0),
        (F.concat(F.lit("integrity sha512-"), b64), 0),
        (F.concat(lead, F.lit(" order "), digits, F.lit(" card "), digits), 0),
    ]
    text, label = F.lit(None).cast("string"), F.lit(0)
    for k, (t, y) in enumerate(kinds):
        text, label = F.when(F.col("k") == k, t).otherwise(text), F.when(F.col("k") == k, F.lit(y)).otherwise(label)
    return r.select("id", text.alias("text"), label.alias("secret"))


def _tree(node) -> Column:
    """A tree of the learner as nested CASE expressions that give the share of secrets in the leaf."""
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return F.lit(float(stats[1] / sum(stats)))
    split = node.split()
    return F.when(F.col(FEATURES[split.featureIndex()]) <= F.lit(float(split.threshold())), _tree(node.leftChild())).otherwise(_tree(node.rightChild()))


def fit(findings: DataFrame, entries: DataFrame) -> tuple[RandomForestClassificationModel, DataFrame]:
    """The learner's forest, and the rows that it was trained on, from labelled findings (text, secret) and a dictionary."""
    rows = with_features(covered(candidates(findings, ["secret"]), entries, findings.sparkSession)).select(F.col("secret").cast("double").alias("label"), *FEATURES)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.coalesce(1))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(data), data


def trees(model: RandomForestClassificationModel) -> list[Column]:
    """The forest's trees as expressions over the features."""
    return [_tree(t._call_java("rootNode")) for t in model.trees]


def train(findings: DataFrame, entries: DataFrame) -> list[Column]:
    return trees(fit(findings, entries)[0])


def scan(docs: DataFrame, forest: list[Column], entries: DataFrame) -> DataFrame:
    """One row for each candidate: doc_id, word, piece, candidate, score (0 to 1) and secret."""
    rows = with_features(covered(candidates(docs, ["doc_id"]), entries, docs.sparkSession))
    total = forest[0]
    for t in forest[1:]:
        total = total + t
    scored = rows.withColumn("score", F.round(total / len(forest), 6))
    return scored.select("doc_id", F.col("word").cast("long").alias("word"), F.col("piece").cast("long").alias("piece"), "candidate", "score", (F.col("score") >= THRESHOLD).alias("secret"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    entries = written(spark, dictionary(docs, spark), "dictionary")
    return scan(docs, train(labelled(spark), entries), entries)
