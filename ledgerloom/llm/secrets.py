"""Secret scans: pattern candidates, and a random forest that takes out false positives.

Only DataFrame and SQL functions touch the documents. A text is cut at the candidates of
``CANDIDATE``; each becomes a row of features: length, character transitions, dictionary
coverage and neighbouring words; a path only counts if the training findings have one, which
those of ``labelled_findings`` have not. The forest is fitted with Spark's own
``RandomForestClassifier`` to labelled findings and then written out as one SQL expression,
so documents are scored where they lie: no shuffle, no join, no Python. The training
tables are written to the shared folder ``spark.checkpoint.dir``.

``labelled_findings`` makes the training table: every document lends its words, and into them a
rule puts secrets (label 1) and look-alikes such as digests, identifiers, paths, placeholders
and long words (label 0), all from hashes of the id. Up to ``FULL_DOCUMENTS`` documents have a
finding of every kind; of more each has fewer, one at least, of kinds that a hash of the id deals
out, so the table grows with the documents. Any other table of ``text`` and ``label`` with one
candidate a text can be used. The dictionary is the ``DICTIONARY_WORDS`` commonest words of all
documents. The forest is fitted by Spark over parts of ``FIT_ROWS`` findings, dealt by a hash.

A candidate has no upper length: tokens run to the end of their run of token characters, assigned
values to a space, separator or closing quote, key blocks to their END line, whatever lines they have.
A key name may be any part of the name that is assigned to (``DB_PASSWORD``, ``clientSecret``).

Defined cases: a null or empty text has no candidates; repeated rows are scanned each;
equal findings in a text are findings of their own, numbered from 1; other columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import settled

from .text import bounded_sample

FULL_DOCUMENTS, DICTIONARY_WORDS, DICTIONARY_LETTERS = 400, 400, 4
FIT_ROWS = 50_000
TREES, DEPTH = 15, 6
THRESHOLD = 0.5
CONTEXT_CHARS = 48
MASK = "[SECRET]"

#: Names that stand before an assigned secret.
KEY_NAMES = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential"
#: What a token, and the name before an assigned value, is made of: a candidate begins where such a run begins and takes it to its end.
#: Repetition without a bound is possessive, so a match takes time and stack in proportion to its length at most.
_RUN = "[A-Za-z0-9+/_-]"
_KEY_END = r"[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
#: A key block runs to its END line; without one, over its header lines and the encoded lines below them.
_BLOCK = (
    rf"-----BEGIN {_KEY_END}(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END {_KEY_END}"
    r"|(?:\s{1,4}[A-Za-z][A-Za-z0-9-]{1,40}: [^\n]*+)*+(?:(?:\s|\\[nr]){1,4}[A-Za-z0-9+/]{16,}+={0,2})*+(?:(?:\s|\\[nr]){1,4}[A-Za-z0-9+/]++={1,2})?)"
)
#: Public formats of keys: cloud key ids, forge tokens, chat tokens, payment keys, web tokens, key blocks.
_FORMATS = (
    r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20}|xox[abprs]-[A-Za-z0-9-]{10}|[sr]k_(?:live|test)_[A-Za-z0-9]{16}"
    rf"|AIza[A-Za-z0-9_-]{{30}}|eyJ[A-Za-z0-9_-]{{8,}}+\.[A-Za-z0-9_-]{{8,}}+\.[A-Za-z0-9_-]{{8}}){_RUN}*+={{0,2}}|{_BLOCK}"
)
#: In quotes a value runs to the closing one, if no space is in between.
_VALUE = rf"{_BLOCK}|(?<=\")[^\s\"]{{6,}}+(?=\")|(?<=')[^\s']{{6,}}+(?=')|[^\s\"'<>,;]{{6,}}+"
_SET = r"[\"']?\s{0,3}[:=]\s{0,3}"
#: The look ahead and the atomic group keep a long run from being tried once for each key name in it.
_ASSIGNED = rf"(?={_RUN}*+{_SET}(?:[\"']?[^\s\"'<>,;]{{6}}|\"[^\s\"]{{6}}|'[^\s']{{6}}))((?>{_RUN}*?(?i:{KEY_NAMES}){_RUN}*+){_SET}[\"']?)({_VALUE})"
_GENERIC = rf"(?=[A-Za-z+/_-]*+[0-9]){_RUN}{{20,}}+={{0,2}}"
#: Group 1: the name before an assigned value, group 2: the value, group 3: any other candidate.
CANDIDATE = rf"(?<!{_RUN})(?:{_ASSIGNED}|({_FORMATS}|{_GENERIC}))"

_TRANSITIONS = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
FEATURES = (
    "length", "digit_share", "upper_share", "symbol_share", "distinct_share", "transition_share", "vowel_pair_share", "hex_only", "known_format",
    "dictionary_share", "has_slash", "has_extension", "path_is_test", "assigned", "key_word_before", "digest_word_before", "sample_word_near", "is_uuid",
)


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters that match."""
    return F.regexp_count(value, F.lit(pattern)) / F.greatest(F.length(value), F.lit(1))


def _features(value: Column, assigned: Column, before: Column, after: Column, path: Column, dictionary: Column) -> dict[str, Column]:
    """The features of a candidate as numbers, in the order of ``FEATURES``."""
    number = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    length = F.greatest(F.length(value), F.lit(1))
    runs = F.regexp_extract_all(F.lower(value), F.lit(rf"(\p{{L}}{{{DICTIONARY_LETTERS},}})"), F.lit(1))
    covered = F.aggregate(runs, F.lit(0), lambda total, run: total + F.when(F.array_contains(dictionary, run), F.length(run)).otherwise(0))
    return {
        "length": F.length(value).cast("double"),
        "digit_share": _share(value, "[0-9]"),
        "upper_share": _share(value, "[A-Z]"),
        "symbol_share": _share(value, r"[^\p{L}0-9]"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / length,
        "transition_share": _share(value, _TRANSITIONS),
        "vowel_pair_share": _share(value, "(?i)[bcdfghjklmnpqrstvwxyz](?=[aeiouy])"),
        "hex_only": number(value.rlike("^[0-9a-fA-F]+$")),
        "known_format": number(value.rlike(rf"^(?:{_FORMATS})$")),
        "dictionary_share": covered / length,
        "has_slash": number(value.contains("/")),
        "has_extension": number(after.rlike(r"^\.[a-z]{1,5}\b")),
        "path_is_test": number(F.lower(path).rlike("test|example|sample|mock|fixture|doc")),
        "assigned": number(assigned),
        "key_word_before": number(F.lower(before).rlike(rf"(?:{KEY_NAMES}|auth|bearer|key|login)\W{{0,6}}$")),
        "digest_word_before": number(F.lower(before).rlike(r"(?:sha\d*|md5|digest|checksum|hash|commit|revision|uuid|guid|id|build|version|integrity)\W{0,6}$")),
        "sample_word_near": number(F.lower(F.concat(before, value, after)).rlike("example|sample|dummy|placeholder|changeme|change_me|your[_-]|xxxx|redacted|test[_-]")),
        "is_uuid": number(value.rlike("(?i)^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$")),
    }


def _candidates(text: Column) -> Column:
    """An array of candidates: ``prefix``, ``value``, ``assigned``, ``before``, ``after``; null where there is none."""
    part = lambda group: F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(group))
    return F.when(text.rlike(CANDIDATE), F.struct(F.split(text, CANDIDATE, -1).alias("rest"), part(1).alias("prefix"), part(2).alias("assigned"), part(3).alias("other")))


def _each(cut: Column, make) -> Column:
    """``make`` of each candidate of a cut text: prefix, value, assigned, before, after."""

    def one(prefix: Column, at: Column) -> Column:
        assigned = prefix != ""
        value = F.when(assigned, F.get(cut["assigned"], at)).otherwise(F.get(cut["other"], at))
        before = F.concat(F.right(F.get(cut["rest"], at), F.lit(CONTEXT_CHARS)), prefix)
        return make(prefix, value, assigned, before, F.left(F.get(cut["rest"], at + 1), F.lit(CONTEXT_CHARS)))

    return F.transform(cut["prefix"], one)


def common_words(docs: DataFrame, text: str = "text", count: int = DICTIONARY_WORDS) -> list[str]:
    """The commonest words of some letters, by documents; ``count`` rows reach the driver."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"(\p{{L}}{{{DICTIONARY_LETTERS},}})"), F.lit(1)))).alias("word"))
    top = words.groupBy("word").count().orderBy(F.col("count").desc(), "word").limit(count)
    return sorted(r.word for r in top.collect())


def labelled_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", full: int | None = None) -> DataFrame:
    """``text`` and ``label``: words of each document around one secret or look-alike.

    All kinds of each document, or, of more than ``full`` documents, about as many findings as ``full`` have; one of each document at least.
    """
    seed = F.sha2(F.concat(F.col(doc_id).cast("string"), F.lit("|finding")), 256)
    pick = lambda at, size: F.substring(seed, at, size)
    mixed = lambda at, size: F.translate(F.translate(F.base64(F.unhex(F.substring(F.sha2(F.concat(seed, F.lit(str(at))), 512), 1, 2 * size))), "=", ""), "+", "-")
    upper = F.upper(F.translate(F.substring(F.base64(F.unhex(seed)), 1, 16), "+/=", "7K3"))
    words = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\p{L}\s]", ""), r"\s+")
    run = lambda low, size: F.array_join(F.slice(words, low, size), " ")
    glued = F.substring(F.array_join(F.slice(words, 2, 6), "_"), 1, 40)
    uuid = F.concat_ws("-", pick(1, 8), pick(9, 4), pick(13, 4), pick(17, 4), pick(21, 12))
    long = lambda at, parts: F.concat(*[F.translate(mixed(f"{at}.{part}", 48), "/", "_") for part in range(parts)])
    body = lambda lines: F.concat_ws("\n", *[mixed(f"k{part}", 48) for part in range(lines)])
    digits = lambda parts: F.concat(*[F.sha2(F.concat(seed, F.lit(f"d{part}")), 512) for part in range(parts)])
    kinds = [
        (1, F.concat(F.lit("DB_PASSWORD="), F.translate(mixed(11, 9), "/", "!"))), (1, F.concat(F.lit("clientSecret: "), F.translate(mixed(12, 18), "/", "$"))), (1, F.concat(F.lit("auth_token_v2='"), mixed(13, 21), F.lit("'"))),
        (1, F.concat(F.lit("my_password: "), F.translate(mixed(14, 8), "+/", "!#"))), (1, F.concat(F.lit("session_token="), long(15, 14))), (1, F.concat(F.lit("Authorization: Bearer "), long(16, 5))),
        (1, F.concat(F.lit("eyJ"), mixed(17, 20), F.lit("."), F.translate(long(18, 3), "+", "-"), F.lit("."), F.translate(mixed(19, 32), "+/", "-_"))),
        (1, F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\n"), body(6), F.lit("\n-----END RSA PRIVATE KEY-----"))), (1, F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), body(40), F.lit("\n-----END PRIVATE KEY-----"))),
        (1, F.concat(F.lit('"private_key": "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\n'), body(2), F.lit('\n-----END RSA PRIVATE KEY-----"'))),
        (1, F.concat(F.lit("Authorization: Bearer "), digits(8))), (1, F.concat(F.lit("Authorization: Bearer "), F.translate(digits(7), "ad", "ZQ"))),
        (0, F.concat(F.lit("max_tokens="), F.translate(pick(1, 6), "abcdef", "012345"))), (0, F.concat(F.lit("secretary: "), F.get(words, F.lit(4)), F.get(words, F.lit(5)))), (0, F.concat(F.lit("tokenizer_name = "), glued)),
        (0, F.concat(F.lit("https://host.example/"), F.array_join(F.slice(words, 2, 60), "/"), F.lit("/1"))), (0, F.concat(F.array_join(F.slice(words, 3, 40), "_"), F.lit("_"), pick(3, 2), F.lit("1"))), (0, F.concat(F.lit("digest "), digits(8))),
        (1, F.concat(F.lit('token = "'), pick(1, 40), F.lit('"'))), (1, F.concat(F.lit("password="), pick(5, 18))), (1, F.concat(F.lit("AKIA"), upper)),
        (1, F.concat(F.lit('TOKEN = "'), F.upper(pick(1, 40)), F.lit('"'))), (1, F.concat(F.lit("api_key: "), mixed(1, 24))), (1, F.concat(F.lit("secret: '"), mixed(2, 12), F.lit("'"))),
        (1, F.concat(F.lit("ghp_"), F.translate(mixed(3, 30), "/-", "ab"))), (1, F.concat(F.lit("sk_live_"), pick(1, 24))), (1, F.concat(F.lit("Authorization: Bearer "), mixed(4, 30))),
        (1, F.concat(F.lit("pwd="), F.translate(mixed(5, 8), "/", "!"))), (1, F.concat(F.lit("AIza"), F.translate(mixed(6, 27), "/", "_"))), (1, F.concat(F.lit("access_key="), mixed(7, 30))),
        (0, F.concat(F.lit("commit "), pick(1, 40))), (0, F.concat(F.lit("sha256: "), seed)), (0, F.concat(F.lit("id "), uuid)), (0, F.concat(F.lit("checksum="), pick(1, 32))),
        (0, F.concat(F.lit("https://host.example/"), glued, F.lit("/"), pick(1, 4))), (0, F.concat(F.lit("see /usr/share/"), glued, F.lit("2/file.txt"))),
        (0, F.concat(glued, F.lit("_"), pick(1, 2), F.lit("1"))), (0, F.lit('password = "your_password_here"')), (0, F.lit("api_key=xxxxxxxxxxxxxxxxxxxx0")),
        (0, F.concat(F.lit("token: "), F.get(words, F.lit(2)), F.lit("ization"))), (0, F.concat(F.lit("password: "), F.get(words, F.lit(3)), F.lit("word"))), (0, F.concat(F.lit("EXAMPLE_KEY_"), pick(1, 12))),
        (0, F.concat(F.lit("2024-01-02T03-04-05_"), pick(1, 3))), (0, F.concat(F.lit("build-"), F.translate(pick(1, 20), "abcdef", "012345"))),
    ]
    each = len(kinds) if full is None else min(len(kinds), -(-full * len(kinds) // max(docs.count(), 1)))
    begin = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(len(kinds)))
    made = [F.struct(F.concat(run(5, 6), F.lit(" "), value, F.lit(" "), run(12, 5)).alias("text"), F.lit(label).alias("label")) for label, value in kinds]
    if each < len(kinds):
        made = [F.when(F.pmod(F.lit(kind) - begin, F.lit(len(kinds))) < each, one) for kind, one in enumerate(made)]
    texts = F.explode(F.array_compact(F.array(*made)))
    return settled(docs.select(F.col(doc_id).alias("_id"), texts.alias("f")).select("_id", "f.text", "f.label"))


class Forest:
    """The dictionary and the forest as a SQL expression."""

    def __init__(self, words: list[str], trees: list):
        self.words, self.trees = words, trees

    def score(self, features: dict[str, Column]) -> Column:
        """The mean probability of the trees."""
        if not self.trees:
            return F.lit(0.0)
        names = list(FEATURES)

        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, cut, low, high = node
            return F.when(features[names[feature]] <= F.lit(cut), walk(low)).otherwise(walk(high))

        return F.round(reduce(lambda a, b: a + b, map(walk, self.trees)) / F.lit(len(self.trees)), 9)

    def dictionary(self) -> Column:
        return F.array(*[F.lit(w) for w in self.words]) if self.words else F.array().cast("array<string>")


def _tree(node) -> tuple | float:
    """A fitted tree as nested tuples: feature, cut, lower side, higher side; a leaf is the share of label 1."""
    if node.numDescendants() == 0:
        stats = list(node.impurityStats().stats())
        return float(stats[1] / max(sum(stats), 1e-12))
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def learn_forest(findings: DataFrame, words: list[str], path: str | None = None) -> Forest:
    """Fit the forest to a table of ``text``, ``label`` and, if named, a path."""
    forest = Forest(words, [])
    place = F.col(path) if path else F.lit("")
    cut = settled(findings.select("text", F.col("label").cast("double").alias("label"), place.alias("path"), _candidates(F.col("text")).alias("cut")).where("cut is not null"))
    one = F.get(_each(F.col("cut"), lambda prefix, value, assigned, before, after: F.struct(*_vector(value, assigned, before, after, F.col("path"), forest))), F.lit(0))
    table = settled(cut.select("label", "text", one.alias("f")).select("label", "text", "f.*"))
    if table.select("label").distinct().count() < 2:
        return forest
    # The fit follows the order of the rows: the same findings come in the same parts and order, however they were written.
    dealt = table.repartition(-(-table.count() // FIT_ROWS), F.xxhash64("text")).sortWithinPartitions("text", "label")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(dealt).select("label", "features")
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="onethird").fit(rows)
    forest.trees = [_tree(t._call_java("rootNode")) for t in model.trees]
    return forest


def _vector(value: Column, assigned: Column, before: Column, after: Column, path: Column, forest: Forest) -> list[Column]:
    return [c.cast("double").alias(name) for name, c in _features(value, assigned, before, after, path, forest.dictionary()).items()]


def learn_from_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int | None = None) -> Forest:
    """Dictionary and forest from the words of all documents, or of about ``sample`` of them."""
    some = docs.select(doc_id, text)
    if sample is not None:
        some = bounded_sample(some.withColumn("_all", F.lit(1)), "_all", sample, doc_id).select(doc_id, text)
    return learn_forest(labelled_findings(some, doc_id, text, None if sample else FULL_DOCUMENTS), common_words(some, text))


def scan(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the document as it came), ``masked`` (its text without secrets), ``findings``: an array of
    ``nth``, ``rule``, ``value``, ``score``, ``is_secret`` for every candidate, null where there is none."""
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    cut = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"), place.alias("path"), _candidates(F.col(text)).alias("cut"))
    # Features first, as their own column, so the trees refer to plain numbers.
    describe = lambda prefix, value, assigned, before, after: F.struct(prefix.alias("prefix"), value.alias("value"), F.struct(*_vector(value, assigned, before, after, F.col("path"), forest)).alias("f"))
    described = cut.withColumn("found", F.when(F.col("cut").isNotNull(), _each(F.col("cut"), describe)))
    score = lambda x: forest.score({name: x["f"][name] for name in FEATURES})
    rule = lambda x: F.when(x["prefix"] != "", "assigned").when(x["f"]["known_format"] == 1, "format").otherwise("generic")
    scored = described.withColumn(
        "found",
        F.transform("found", lambda x, at: F.struct((at + 1).alias("nth"), x["prefix"].alias("prefix"), x["value"].alias("value"), rule(x).alias("rule"), score(x).alias("score"))),
    ).withColumn("found", F.transform("found", lambda x: x.withField("is_secret", x["score"] >= threshold)))
    shown = F.transform("found", lambda x: F.concat(x["prefix"], F.when(x["is_secret"], F.lit(MASK)).otherwise(x["value"])))
    masked = F.array_join(F.flatten(F.zip_with(F.col("cut.rest"), shown, lambda rest, value: F.array(rest, F.coalesce(value, F.lit(""))))), "")
    return scored.select("row", F.when(F.col("found").isNotNull(), masked).otherwise(F.col("text")).alias("masked"), F.transform("found", lambda x: x.dropFields("prefix")).alias("findings"))


def mask_secrets(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``MASK``; all rows and columns stay."""
    scanned = scan(docs, forest, text, path)
    return scanned.select(*[F.col("masked").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def secrets_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """One row per candidate of every document: id, number in the text, rule, digest of the value, length, score, verdict."""
    forest = learn_from_documents(docs, doc_id, text)
    given = docs.select(doc_id, text, *([path] if path else []))
    found = scan(given, forest, text, path).where("findings is not null").select(F.col(f"row.{doc_id}").alias(doc_id), F.explode("findings").alias("x"))
    return found.select(
        doc_id, F.col("x.nth").alias("nth"), F.col("x.rule").alias("rule"), F.sha2(F.col("x.value").cast("binary"), 256).alias("value_sha256"),
        F.length("x.value").alias("n_chars"), F.col("x.score").alias("score"), F.col("x.is_secret").alias("is_secret"),
    )
