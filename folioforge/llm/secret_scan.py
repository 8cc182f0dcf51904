"""Secret scans: candidates found by patterns, false positives removed by a random forest.

All of it is DataFrame expressions. A text is split at its candidates, so that each has its own length and characters
and the words before and after it at hand without another search. The forest is trained on labelled findings, by default
made by rule: live keys and tokens beside the hashes, ids and numbers that look like them. It's then written out as
expressions over a finding's features, so that texts are judged and redacted in place, without a shuffle.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh

# Words that stand before a secret, words that stand before what only looks like one, and parts of paths of tests and examples.
KEY_WORDS = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key|client[_-]?secret"
HASH_WORDS = "sha1|sha256|sha|md5|commit|checksum|digest|hash|uuid|guid|revision|build|etag|order|invoice|isbn|phone|card|serial|version"
TEST_PATHS = "test|example|sample|fixture|mock|demo"
# Common words of code and of four languages, and common endings, for dictionary coverage.
WORDS = (
    "the and for are but not you all any can had her was one our out day get has him his how man new now old see two way who "
    "about after again also area back base been before being below both came case come could data does done down each even "
    "every find first found from give good great hand have head help here high home house into just keep kind know last late "
    "left less life like line list long look made make many more most much must name need next only open other over part "
    "place point read right same school seem should show side small some state still such take tell than that them then there "
    "these they thing think this time under until value very want water well were what when where which while will with "
    "word work world would write year your "
    "true false none null user test sample example dummy password changeme placeholder comment chapter version token secret key "
    "config default admin demo index number string content file path "
    "der die das und ist nicht ein eine auf mit den von que los las una por con para les des est pour dans sur avec une "
    "ation ingly ment ness able ing ung ion ent ter ous ver ith est ed er ly in on re th an en un"
).split()
DICTIONARY = "|".join(sorted(dict.fromkeys(WORDS), key=lambda w: (-len(w), w)))
#: What is looked at: known key formats, passwords in addresses, long runs of key characters with a digit among them, longer ones without, and values given to a key word. What assigns a value is found with it.
CANDIDATE = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}\b|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|://[^\s/:@\"']*+:[^\s/@\"']{3,}+(?=@)"
    r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"
    r"|(?<![A-Za-z0-9+/_-])(?=[+/_-]*+[A-Za-z])[A-Za-z+/_-]{24,}={0,2}"
    r"|[=:](?<=(?i:token|secret|password|passwd|pwd|key|auth)[\"']?\s{0,2}[=:])\s{0,2}[\"']?[^\s\"'=:<>(){},;|&]{6,}"
)
ASSIGNS = r"^(?:://[^\s/:@\"']*:|[=:]\s{0,2}[\"']?)"
REDACTED = "[REDACTED]"
CONTEXT = 40
FEATURES = ("length", "digits", "upper", "lower", "other", "changes", "letter_digit_changes", "rare_pairs", "hex_only", "digits_only", "dashes", "coverage", "known", "assigned", "key_word", "hash_word", "after_closes", "test_path")


def _count(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)).cast("double")


def _holds(value: Column, pattern: str) -> Column:
    return value.rlike(pattern).cast("double")


def features(value: Column, before: Column, after: Column, path: Column) -> Column:
    """A struct of doubles: length, character transitions, dictionary coverage, path and neighbouring words."""
    n = F.greatest(F.length(value), F.lit(1)).cast("double")
    unquoted = F.regexp_replace(before, r"[\"'=:\s]+$", "")
    near = F.regexp_extract(unquoted, r"([A-Za-z0-9_-]{0,24})$", 1)
    columns = {
        "length": n,
        "digits": _count(value, "[0-9]") / n,
        "upper": _count(value, "[A-Z]") / n,
        "lower": _count(value, "[a-z]") / n,
        "other": _count(value, "[^A-Za-z0-9]") / n,
        "changes": _count(value, "[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])") / n,
        "letter_digit_changes": _count(value, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])") / n,
        "rare_pairs": _count(value, "(?i)[bcdfghjklmnpqrstvwxz](?=[bcdfgjkmpqvwxz])|[jqvxz](?=[^aeiou])") / n,
        "hex_only": _holds(value, "^[0-9a-fA-F]+$"),
        "digits_only": _holds(value, "^[0-9+_-]+$"),
        "dashes": _count(value, "[-_/]"),
        "coverage": F.lit(1.0) - F.length(F.regexp_replace(value, f"(?i)(?:{DICTIONARY})", "")) / n,
        "known": _holds(value, r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-)"),
        "assigned": _holds(before, r"[=:]\s{0,2}[\"']?$"),
        "key_word": _holds(near, f"(?i)(?:{KEY_WORDS})$"),
        "hash_word": _holds(unquoted, rf"(?i)\b(?:{HASH_WORDS})\b"),
        "after_closes": _holds(after, "^[\"'@]"),
        "test_path": _holds(path, f"(?i)(?:{TEST_PATHS})"),
    }
    return F.struct(*[F.coalesce(columns[k], F.lit(0.0)).alias(k) for k in FEATURES])


def labelled_findings(spark: SparkSession, rows: int = 8000, first: int = 0) -> DataFrame:
    """Findings with a label, made by rule from hashes of the numbers from `first` on: value, before, after, path, label.

    The label follows from how a value was made, not from where it stands: even numbers are live, drawn at random (provider
    keys, hex, base64, letters alone, passwords), odd ones are not (hashes and ids, numbers, words, placeholders, paths,
    provider keys that spell words, and dummy keys, random ones on a path of tests). Neighbouring words are drawn for both
    from the same kinds, in other shares: a live value stands mostly behind a key word, but one in ten behind the name of a
    hash, and a dead one behind a key word in one of six, a placeholder or dummy key mostly. No feature tells the label.
    """
    pick = (F.col("id") / 2).cast("long")
    hexed = F.sha2(F.concat(F.lit("v"), F.col("id")).cast("binary"), 256)
    mixed = F.translate(F.base64(F.unhex(hexed)), "=", "")
    letters = F.translate(mixed, "0123456789+/", "qZkWvXjRpTyB")
    number = F.regexp_replace(F.concat(F.conv(F.substring(hexed, 1, 14), 16, 10), F.conv(F.substring(hexed, 15, 10), 16, 10)), "[^0-9]", "0")

    def draw(salt: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), F.col("id")), F.lit(n))

    def one_of(salt: str, *texts: str | Column) -> Column:
        return F.element_at(F.array(*[F.lit(t) if isinstance(t, str) else t for t in texts]), (draw(salt, len(texts)) + 1).cast("int"))

    word = lambda salt: one_of(salt, *WORDS[::3])
    live = [
        F.concat(F.lit("AKIA"), F.substring(F.translate(F.upper(mixed), "+/", "QZ"), 1, 16)),
        F.concat(F.lit("ghp_"), F.substring(F.translate(mixed, "+/", "aZ"), 1, 38)),
        F.substring(hexed, 1, 40),
        one_of("h", F.substring(hexed, 1, 16), F.substring(hexed, 1, 32), hexed),
        mixed,
        F.substring(letters, 1, 32),
        F.concat(F.substring(letters, 1, 5), one_of("q", "!", "#", "$", "%", "?", "7"), F.substring(hexed, 1, 5)),
    ]
    dummy = one_of("y", F.substring(hexed, 1, 40), F.substring(hexed, 1, 16), mixed)
    dead = [
        F.substring(hexed, 1, 40),
        one_of("h", hexed, F.substring(hexed, 1, 32), F.substring(hexed, 1, 16)),
        F.substring(number, 1, 16),
        F.concat_ws("_", word("a"), word("b"), word("c"), F.substring(number, 1, 3)),
        F.concat_ws("-", F.substring(hexed, 1, 8), F.substring(hexed, 9, 4), F.substring(hexed, 13, 4), F.substring(hexed, 17, 4), F.substring(hexed, 21, 12)),
        one_of("g", F.concat(*[F.initcap(word(x)) for x in "abcdef"]), F.concat(*[word(x) for x in "abcdefg"]), F.initcap(F.concat(*[word(x) for x in "abcdefg"]))),
        F.concat_ws("/", word("a"), word("b"), word("c"), word("d"), F.substring(number, 1, 2)),
        one_of("d", "changeme", "your_password_here", "example_value", "placeholder123", "none_needed", "test_user_name", "insert-token-here"),
        F.concat(F.lit("AKIA"), F.substring(F.upper(F.concat(word("a"), word("b"), word("c"), word("d"), F.lit("EXAMPLEEXAMPLE"))), 1, 16)),
        dummy,
        dummy,
    ]
    even = F.col("id") % 2 == 0
    kind = F.pmod(pick, F.when(even, len(live)).otherwise(len(dead)))
    value = F.when(even, F.element_at(F.array(*live), (F.pmod(pick, F.lit(len(live))) + 1).cast("int"))).otherwise(F.element_at(F.array(*dead), (F.pmod(pick, F.lit(len(dead))) + 1).cast("int")))
    prose = one_of("p", "the thing and ", "und der die ", "que los de la ", "est pour les ", "ation. ", "", "see ")
    keyed = F.concat(prose, one_of("k", 'token = "', "password=", "api_key: ", "secret='", 'ACCESS_KEY = "', "Authorization: Bearer ", "client_secret=", "passwd: ", 'auth_token="'))
    hashed = F.concat(prose, one_of("n", "sha256: ", "commit ", "md5 = ", 'checksum="', "uuid ", "order ", "build=", "revision: ", "phone "))
    plain = F.concat(prose, one_of("m", "", "", "value = ", 'x: "', "id "))
    address = F.concat(prose, one_of("u", "postgres://admin:", "https://user:", "ftp://backup:"))
    place = draw("w", 100)
    often = ~even & kind.isin(7, 9, 10)  # placeholders and dummy keys
    before = (
        F.when(even & (kind == 6) & (place < 35), address)
        .when(even, F.when(place < 75, keyed).when(place < 90, plain).otherwise(hashed))
        .when(often, F.when(place < 85, keyed).otherwise(plain))
        .otherwise(F.when(place < 45, hashed).when(place < 84, plain).otherwise(keyed))
    )
    after = F.when(even & (kind == 6) & (place < 35), F.lit("@db")).otherwise(one_of("c", '" then', "' and", " the", "", "\nof", '"'))
    share = draw("s", 40)
    tried = F.when(even, share == 0).otherwise((kind >= 9) | (share < 20))
    folder = F.when(tried, one_of("t", "tests/", "src/test/", "examples/", "fixtures/", "samples/", "mocks/", "demo/")).otherwise(one_of("r", "src", "src/app/", "lib/", "docs/", "conf/"))
    path = F.concat(folder, F.pmod(F.xxhash64("id"), F.lit(40)).cast("string"))
    return spark.range(first, first + rows).select(value.alias("value"), before.alias("before"), after.alias("after"), path.alias("path"), even.cast("double").alias("label"))


def train_forest(findings: DataFrame, trees: int = 15, depth: int = 7, max_rows: int = 20_000, seed: int = 11):
    """A random forest over labelled findings, of which max_rows at most are used: those of the smallest hash."""
    x = findings.withColumn("x", features(F.col("value"), F.col("before"), F.col("after"), F.coalesce(F.col("path"), F.lit("")))).orderBy(F.xxhash64("value", "before")).limit(max_rows).select("x.*", F.col("label").cast("double").alias("label"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="0.5", minInstancesPerNode=5).fit(vectors)


def forest_nodes(model) -> list:
    """The trees as nested tuples (feature, threshold, left, right), leaves as the share of live findings."""

    def walk(node):
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return stats[1] / max(sum(stats), 1e-9)
        split = node.split()
        return FEATURES[split.featureIndex()], split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return [walk(tree._java_obj.rootNode()) for tree in model.trees]


def forest_score(trees: list, x: Column) -> Column:
    """The mean of the trees' answers, 0 to 1, as an expression over a struct of features."""

    def column(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(float(node))
        name, threshold, left, right = node
        return F.when(x[name] <= float(threshold), column(left)).otherwise(column(right))

    total = column(trees[0])
    for tree in trees[1:]:
        total = total + column(tree)
    return total / len(trees)


_TRAINED: dict[str, list] = {}


def default_forest(spark: SparkSession) -> list:
    """The forest of the labelled findings made by rule, trained once a Spark application."""
    key = spark.sparkContext.applicationId
    if key not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[key] = forest_nodes(train_forest(labelled_findings(spark)))
    return _TRAINED[key]


def _findings(docs: DataFrame, text: Column, path: Column, trees: list, parts: str, found: str) -> DataFrame:
    """docs with two columns more: what lies between the candidates of text, and the candidates with their score.

    Both are null where there is no candidate. Steps are columns or lambda variables of their own, so that no pattern
    runs twice over a text and no feature is made twice for a candidate.
    """
    (values,) = fresh(docs, "candidate_values")
    has = text.rlike(CANDIDATE)
    split = docs.withColumns({values: F.when(has, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))), parts: F.when(has, F.split(text, CANDIDATE, -1))})
    between = F.col(parts)

    def context(match: Column, k: Column) -> Column:
        before, after = F.element_at(between, (k + 1).cast("int")), F.element_at(between, (k + 2).cast("int"))
        assigns = F.regexp_extract(match, ASSIGNS, 0)
        value = F.substring(match, F.length(assigns) + 1, F.length(match))
        return F.struct(k.cast("int").alias("n"), assigns.alias("assigns"), value.alias("value"), F.length(before).alias("gap"), F.concat(F.right(before, F.lit(CONTEXT)), assigns).alias("before"), F.left(after, F.lit(CONTEXT)).alias("after"))

    kept = ("n", "assigns", "value", "gap")
    with_features = lambda f: F.struct(*[f[k].alias(k) for k in kept], features(f["value"], f["before"], f["after"], path).alias("x"))
    scored = lambda f: F.struct(*[f[k].alias(k) for k in kept], forest_score(trees, f["x"]).alias("score"))
    return split.withColumn(found, F.transform(F.transform(F.transform(F.col(values), context), with_features), scored)).drop(values)


def scan(docs: DataFrame, trees: list | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row a candidate: doc_id, finding_no (from 0), start (characters from 0), n_chars, value_sha256, score, is_secret.

    Null and empty texts have no candidates; a null path is an empty one. Repeated rows each give their findings.
    Values themselves aren't returned. Other columns are not read.
    """
    trees = default_forest(docs.sparkSession) if trees is None else trees
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"))
    each = _findings(rows, F.col("text"), F.col("path"), trees, "parts", "found").select("row", "doc_id", F.explode("found").alias("f"))
    upto = Window.partitionBy("row").orderBy("f.n")  # the findings of one text
    end = F.sum(F.col("f.gap") + F.length("f.assigns") + F.length("f.value")).over(upto)
    return each.select("doc_id", F.col("f.n").alias("finding_no"), (end - F.length("f.value")).alias("start"), F.length("f.value").alias("n_chars"), F.sha2("f.value", 256).alias("value_sha256"), F.col("f.score").alias("score"), (F.col("f.score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, trees: list | None = None, threshold: float = 0.5, text_col: str = "text", path_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """The rows of docs, all of them and all columns, with secrets in the text replaced by REDACTED.

    length_col, if docs has it, is made the new length of changed texts. Null texts and texts without a secret stay
    as they are.
    """
    trees = default_forest(docs.sparkSession) if trees is None else trees
    text = F.col(f"`{text_col}`")
    parts, found, out = fresh(docs, "text_parts", "found_secrets", "redacted_text")
    judged = _findings(docs, text, F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")), trees, parts, found)
    pieces = F.transform(F.col(found), lambda f: F.concat(F.element_at(F.col(parts), (f["n"] + 1).cast("int")), f["assigns"], F.when(f["score"] >= threshold, F.lit(REDACTED)).otherwise(f["value"])))
    changed = F.exists(F.col(found), lambda f: f["score"] >= threshold)
    made = judged.withColumn(out, F.when(changed, F.concat(F.array_join(pieces, ""), F.element_at(F.col(parts), -1))))
    columns = []
    for c in docs.columns:
        kind = docs.schema[c].dataType
        if c == text_col:
            columns.append(F.coalesce(F.col(out), text).alias(c))
        elif c == length_col:
            columns.append(F.when(F.col(out).isNotNull(), F.length(out)).otherwise(F.col(f"`{c}`")).cast(kind).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return made.select(*columns)
