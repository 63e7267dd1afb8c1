"""Secret scanning with a random forest, with DataFrame functions only.

Candidates are what follows a secret word and = or :, whatever its characters,
runs with a known key's beginning, and all other runs of 12 key-like characters
or more that hold a digit; the forest rejects the false ones. Each is described
by its length, its characters and the transitions between their classes, how
much of it words of the corpus cover, whether it stands in a path, address or
assignment, and the words beside it; a random forest trained on labelled
findings then tells secrets from false positives (card and phone numbers,
hashes in version histories, identifiers, placeholders).

Labelled findings are a table (before, candidate, after, label) of at most
``most_findings`` rows. :func:`made_findings` derives one from the formats of
keys and of their usual look-alikes, the same on every run. The dictionary is
the words that ``common`` documents or more contain; it is counted over all
documents, but only for the words inside candidates.

Defined results: a null or empty text has no findings; a repeated row has its
findings again; equal candidates of a text are separate findings, numbered from
0 in text order; ids may be null; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgam.llm.common import cut, small

#: A name that holds a secret word, up to its = or : and an opening quote; behind it any run without spaces and quotes is a candidate.
KEYED = (
    r"(?<=[=:][\s\"'`]{0,3})(?<![\w$!@#%&*+./~^-])(?<=(?i:passw(?:or)?d|passphrase|pwd|pass|secret|token|api[ _-]?key|(?:access|private|client|session|aws|auth|secret)[ _-]?key|auth|authorization|credentials?)"
    r"[\w-]{0,20}[\"'`]?[ \t]{0,2}[=:]{1,2}[ \t]{0,2}[\"'`]?)"
)
VALUE = r"(?=[^=:])(?:(?!&\w+=|[.,;:)\]}>]+(?:[\s\"'`]|$))[^\s\"'`])+"
RUN = "(?<![A-Za-z0-9+/_-])"
#: Known beginnings of keys; these need neither digit nor length.
PREFIXED = RUN + "(?:A(?:KI|SI)A|gh[opsur]_|github_pat_|glpat-|[sr]k_live_|xox[abprs]-|AIza)[A-Za-z0-9+/_-]+={0,2}"
CANDIDATE = f"{KEYED}{VALUE}|{PREFIXED}|{RUN}(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{12,}}={{0,2}}"
#: Sets candidates off in their text; a character that Unicode keeps out of texts, and that counts as U+FFFD if one has it.
MARK = "\ufdd0"
#: Characters of context that are looked at on either side.
CONTEXT = 48

# Words that stand beside secrets, and beside what only looks like one.
KEYWORDS = "password passwd passphrase pwd pass secret token apikey api key auth authorization bearer credential credentials private access client aws session".split()
LOOKALIKES = (
    "commit sha sha1 sha256 md5 hash checksum digest revision rev uuid guid id isbn issn doi phone tel fax card visa iban account invoice order ticket build version "
    "example sample dummy placeholder test fake changeme your".split()
)
WORDS = "house wird para with report that dans river harbour garden nicht window number table carta noche value maison".split()
PATHS = "test tests example examples sample samples doc docs fixture fixtures mock mocks".split()


def context_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(id, path, nth, candidate, before, after) of every candidate: each text is matched once, candidates set off by ``MARK``."""
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit(None).cast("string")
    marked = F.regexp_replace(F.translate(F.col(f"`{text_col}`"), MARK, "\ufffd"), f"({CANDIDATE})", f"{MARK}$1{MARK}")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), path.alias("path"), marked.alias("marked")).filter(F.contains("marked", F.lit(MARK)))
    parts = rows.select("id", "path", F.split("marked", MARK).alias("parts"))
    each = F.transform(
        F.sequence(F.lit(1), F.size("parts") - 2, F.lit(2)),
        lambda i: F.struct(F.get("parts", i).alias("candidate"), F.right(F.get("parts", i - 1), F.lit(CONTEXT)).alias("before"), F.left(F.get("parts", i + 1), F.lit(CONTEXT)).alias("after")),
    )
    return parts.select("id", "path", F.posexplode(each).alias("nth", "c")).select("id", "path", F.col("nth").cast("long"), "c.candidate", "c.before", "c.after")


def words_in(text: Column) -> Column:
    """The runs of four ASCII letters or more, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]{4,}"), F.lit(0))


def dictionary(docs: DataFrame, text_col: str = "text", common: int = 5, asked: DataFrame | None = None) -> DataFrame:
    """(word): the words that ``common`` documents of all contain; with ``asked`` (word), only those of them."""
    words = docs.select(F.explode(F.array_distinct(words_in(F.col(text_col)))).alias("word"))
    if asked is not None:
        words = words.join(small(asked.select("word").distinct()), "word", "left_semi")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= common).select("word")


def covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """(candidate, coverage): share of each distinct candidate's characters inside dictionary words."""
    runs = found.select("candidate").distinct().select("candidate", F.explode_outer(words_in(F.col("candidate"))).alias("word"))
    known = runs.select("word").filter("word is not null").distinct().join(words, "word", "left_semi").withColumn("known", F.lit(1))
    share = F.sum(F.when(F.col("known") == 1, F.length("word")).otherwise(0)) / F.first(F.length("candidate"))
    return runs.join(known, "word", "left").groupBy("candidate").agg(share.alias("coverage"))


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def features(found: DataFrame) -> DataFrame:
    """``found`` (with a column coverage) and one number column for each feature."""
    c, left, right = F.col("candidate"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    near = F.slice(F.reverse(context_words(left)), 1, 3)
    beside = F.slice(context_words(right), 1, 2)
    listed = lambda words: F.array(*map(F.lit, words))
    # A key is neither cut into words by separators nor spelled in one class of characters
    change = "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[+/_=-])(?=[^+/_=-])"
    path_words = context_words(F.coalesce("path", F.lit("")))
    columns = {
        "f_length": F.least(F.length(c), F.lit(200)),
        "f_digits": _share(c, "[0-9]"),
        "f_upper": _share(c, "[A-Z]"),
        "f_lower": _share(c, "[a-z]"),
        "f_signs": _share(c, "[+/_=-]"),
        "f_others": _share(c, "[^A-Za-z0-9+/_=-]"),
        "f_hex": _share(c, "[0-9a-f]"),
        "f_changes": F.regexp_count(c, F.lit(change)) / F.length(c),
        "f_letter_digit": _share(c, "[A-Za-z](?=[0-9])"),
        "f_distinct": F.size(F.array_distinct(F.split(F.left(c, F.lit(200)), ""))) / F.least(F.length(c), F.lit(200)),
        "f_repeats": _share(c, r"(.)(?=\1)"),
        "f_vowels": _share(c, "(?i)[aeiou]"),
        "f_upper_prefix": F.length(F.regexp_extract(c, "^[A-Z]*", 0)),
        "f_coverage": F.coalesce("coverage", F.lit(0.0)),
        "f_assigned": F.when(left.rlike("[=:]\\s*[\"'`]?$"), 1).otherwise(0),
        "f_quoted": F.when(left.rlike("[\"'`]$") & right.rlike("^[\"'`]"), 1).otherwise(0),
        "f_address": F.when(left.rlike("(://\\S*|[/.@#?&]|\\bwww\\S*)$"), 1).otherwise(0),
        "f_slashes": F.regexp_count(c, F.lit("/")),
        "f_keyword": F.size(F.array_intersect(near, listed(KEYWORDS))),
        "f_lookalike": F.size(F.array_intersect(F.concat(near, beside), listed(LOOKALIKES))),
        "f_placeholder": F.when(F.lower(c).rlike("example|sample|dummy|changeme|your|xxxx|1234567|abcdef|test"), 1).otherwise(0),
        "f_path": F.when(F.arrays_overlap(path_words, listed(PATHS)), 1).otherwise(0),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in columns.items()})


FEATURES = (
    "f_length f_digits f_upper f_lower f_signs f_others f_hex f_changes f_letter_digit f_distinct f_repeats f_vowels f_upper_prefix f_coverage f_assigned f_quoted f_address "
    "f_slashes f_keyword f_lookalike f_placeholder f_path".split()
)


def made_findings(spark: SparkSession, each: int = 250) -> DataFrame:
    """Labelled findings (before, candidate, after, label), ``each`` of every kind, from formats and hashes of their numbers."""
    rows = spark.range(0, each, 1, 1)
    hexes = lambda salt, n: F.left(F.concat(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), F.sha1(F.concat(F.lit(salt), F.col("id").cast("string")))), F.lit(n))
    base = lambda salt, n: F.left(F.regexp_replace(F.base64(F.unhex(hexes(salt, 96))), "[+/=]", "A"), F.lit(n))
    caps = lambda salt, n: F.left(F.regexp_replace(F.upper(base(salt, 64)), "[089]", "Q"), F.lit(n))
    digits = lambda salt, n: F.left(F.regexp_replace(F.translate(hexes(salt, 64), "abcdef", "012345"), "[^0-9]", ""), F.lit(n))
    one_of = lambda salt, *words: F.get(F.array(*map(F.lit, words)), F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(words))))
    word = lambda salt: one_of(salt, "the", "house", "and", "wird", "para", "with", "report", "that", "les", "dans", "river", "onst", "der", "of")
    prose = F.concat(word("p"), F.lit(" "), word("q"), F.lit(" "))
    tail = F.concat(F.lit(" "), word("r"), F.lit(" "), word("s"))
    kinds = [
        (1, prose, F.concat(F.lit("AKIA"), caps("ak", 16)), tail),
        (1, F.concat(prose, one_of("sl", "AWS_ACCESS_KEY_ID=", "access key: ", "aws key ")), F.concat(F.lit("AKIA"), caps("al", 16)), tail),
        (1, F.concat(prose, one_of("pw", "password=", "passwd=", "pwd: ", "password: '", "PASSWORD=")), hexes("pw", 18), tail),
        (1, F.concat(prose, one_of("px", "password=", "secret=", "passphrase: ")), base("px", 14), tail),
        (1, F.concat(prose, F.lit('token = "')), hexes("tk", 40), F.concat(F.lit('"'), tail)),
        (1, F.concat(prose, one_of("tl", "api_key = '", "apikey: \"", "auth_token=\"", "secret_key = \"")), base("tl", 40), F.concat(F.lit('"'), tail)),
        (1, F.concat(prose, one_of("gh", "token ", "use ", "")), F.concat(F.lit("ghp_"), base("gh", 36)), tail),
        (1, prose, F.concat(F.lit("sk_live_"), base("sk", 24)), tail),
        (1, F.concat(prose, F.lit("Authorization: Bearer ")), base("be", 48), tail),
        (0, F.concat(prose, one_of("cc", "", "card ", "visa: ", "account ")), digits("cc", 16), tail),
        (0, F.concat(prose, one_of("ph", "tel ", "+", "fax: ", "phone=")), digits("ph", 12), tail),
        (0, F.concat(prose, one_of("cm", "commit ", "revision ", "sha1: ", "hash ", "checksum=")), hexes("cm", 40), tail),
        (0, F.concat(prose, one_of("md", "md5 ", "md5: ", "digest = ", "build ")), hexes("md", 32), tail),
        (0, F.concat(prose, one_of("uu", "id ", "uuid: ", "order ", "")), F.concat_ws("-", hexes("u1", 8), hexes("u2", 4), hexes("u3", 4), hexes("u4", 4), hexes("u5", 12)), tail),
        (0, prose, F.concat(word("i1"), F.lit("_"), word("i2"), F.lit("_value_"), digits("i3", 3)), tail),
        (0, F.concat(prose, F.lit("https://site.example/")), F.concat(word("w1"), F.lit("/"), word("w2"), F.lit("/"), digits("w3", 6)), tail),
        (0, prose, F.concat(F.lit("20"), digits("d1", 2), F.lit("-0"), digits("d2", 1), F.lit("-1"), digits("d3", 1), F.lit("T10")), F.concat(F.lit(":00"), tail)),
        (0, F.concat(prose, one_of("pl", "password=", "api_key = '", "token: ")), one_of("pm", "xxxxxxxxxxxx1234", "EXAMPLEKEY123456", "your_api_key_1", "changeme12345678", "abcdefgh12345678", "test_token_00001"), tail),
    ]
    parts = [rows.select(before.alias("before"), key.alias("candidate"), after.alias("after"), F.lit(float(label)).alias("label")) for label, before, key, after in kinds]
    return reduce(DataFrame.unionAll, parts).coalesce(1)


def worded_findings(spark: SparkSession, each: int = 250) -> DataFrame:
    """Labelled findings (before, candidate, after, label, path) that hold words of ``WORDS`` or stand in files of tests and examples."""
    rows = spark.range(0, each, 1, 1)
    digest = lambda salt: F.concat(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), F.sha1(F.concat(F.lit(salt), F.col("id").cast("string"))))
    base = lambda salt, n: F.left(F.regexp_replace(F.base64(F.unhex(digest(salt))), "[+/=]", "A"), F.lit(n))
    digits = lambda salt, n: F.left(F.translate(digest(salt), "abcdef", "012345"), F.lit(n))
    one_of = lambda salt, *words: F.get(F.array(*map(F.lit, words)), F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(words))))
    word = lambda salt: one_of(salt, *WORDS)
    prose = F.concat(word("wp"), F.lit(" "), word("wq"), F.lit(" "))
    tail = F.concat(F.lit(" "), word("wr"), F.lit(" "), word("ws"))
    code, tests = one_of("wf", "src/main.py", "app/settings.py", "deploy/config.yml"), one_of("wt", "tests/test_login.py", "docs/samples/readme.md", "examples/demo.py", "spec/fixtures/keys.txt")
    nowhere = F.lit(None).cast("string")
    assigned = one_of("wa", "password=", "api_key = '", 'token = "', "secret: ", "")
    shape = F.when(F.col("id") % 2 == 0, F.concat(F.lit("AKIA"), F.upper(base("wk", 16)))).otherwise(F.left(digest("wk"), F.lit(40)))
    kinds = [
        (0, F.concat(prose, assigned), F.concat(word("a1"), F.lit("_"), word("a2"), F.lit("_"), digits("a3", 4)), tail, nowhere),
        (0, F.concat(prose, assigned), F.concat_ws("-", word("b1"), word("b2"), word("b3"), digits("b4", 2)), tail, code),
        (1, F.concat(prose, assigned), F.concat_ws("_", base("c1", 9), base("c2", 8), digits("c3", 4)), tail, nowhere),
        (1, F.concat(prose, assigned), F.concat_ws("-", base("d1", 7), base("d2", 7), base("d3", 7), digits("d4", 2)), tail, code),
        (0, F.concat(prose, assigned), shape, tail, tests),
        (1, F.concat(prose, assigned), shape, tail, code),
    ]
    parts = [rows.select(before.alias("before"), key.alias("candidate"), after.alias("after"), F.lit(float(label)).alias("label"), path.alias("path")) for label, before, key, after, path in kinds]
    return reduce(DataFrame.unionAll, parts).coalesce(1)


def keyed_findings(spark: SparkSession, each: int = 250) -> DataFrame:
    """Labelled findings (before, candidate, after, label): what people choose as passwords, and what else follows a secret word."""
    rows = spark.range(0, each, 1, 1)
    digest = lambda salt: F.concat(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), F.sha1(F.concat(F.lit(salt), F.col("id").cast("string"))))
    letters = lambda salt, n: F.left(F.translate(digest(salt), "0123456789", "ghijklmnop"), F.lit(n))
    base = lambda salt, n: F.left(F.regexp_replace(F.base64(F.unhex(digest(salt))), "[+/=]", "A"), F.lit(n))
    digits = lambda salt, n: F.left(F.translate(digest(salt), "abcdef", "012345"), F.lit(n))
    one_of = lambda salt, *words: F.get(F.array(*map(F.lit, words)), F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(words))))
    word = lambda salt: one_of(salt, *WORDS)
    sign = lambda salt: one_of(salt, "!", "$", "&", "#", "@", "%", "*", "?", ".")
    prose = F.concat(word("kp"), F.lit(" "), word("kq"), F.lit(" "))
    tail = F.concat(F.lit(" "), word("kr"), F.lit(" "), word("ks"))
    name = lambda salt: F.concat(prose, one_of(salt, "password=", "passwd=", "pwd=", "DB_PASSWORD=", "password: ", "secret=", "passphrase=", "token="))
    mixed = lambda salt: F.regexp_replace(F.initcap(word(salt)), "o", "0")
    caps = F.left(F.translate(F.upper(F.concat(letters("kc", 40))), "GHIJ", "XYZW"), F.lit(16))
    kinds = [
        (1, name("n1"), F.concat(word("k1"), digits("k2", 1)), tail),
        (1, name("n2"), F.concat(mixed("k3"), letters("k4", 3), sign("k5"), digits("k6", 2)), tail),
        (1, name("n3"), F.concat(letters("k7", 4), sign("k8"), base("k9", 5), sign("ka")), tail),
        (1, name("n4"), F.concat(word("kb"), word("kd"), word("ke")), tail),
        (1, name("n5"), F.concat_ws("-", word("kf"), word("kg"), word("kh"), word("ki")), tail),
        (1, name("n6"), letters("kj", 14), tail),
        (1, prose, F.concat(F.lit("AKIA"), caps), tail),
        (1, F.concat(prose, one_of("m4", "https://site.example/?password=", "http://site.example/in?user=x&token=", "https://site.example/a?api_key=")), F.when(F.col("id") % 2 == 0, F.left(digest("kz"), F.lit(18))).otherwise(base("kz", 20)), F.concat(one_of("m5", "&page=2", ""), tail)),
        (0, F.concat(prose, one_of("m1", "password: ", "token: ", "secret: ", "pass: ", "auth: ", "passphrase: ", "token=", "secret=")), word("l1"), tail),
        (0, F.concat(prose, one_of("m2", "password=", "token = ", "secret: ", "api_key=", "pwd=")), one_of("l2", "none", "null", "true", "false", "****", "xxxx", "<password>", "${TOKEN}", "{token}", "$PASSWORD", "changeme", "your_password", "os.environ[", "required", "..."), tail),
        (0, F.concat(prose, one_of("m3", "token: ", "tokens=", "pass: ", "max_tokens=", "auth: ", "password_length=")), digits("l3", 2), tail),
        (0, prose, F.concat(one_of("l4", "AKIA", "AIza", "ghp_", "sk_live_"), one_of("l5", "s", "tion", "_name", "-like", "bel")), tail),
    ]
    parts = [rows.select(before.alias("before"), key.alias("candidate"), after.alias("after"), F.lit(float(label)).alias("label")) for label, before, key, after in kinds]
    return reduce(DataFrame.unionAll, parts).coalesce(1)


def all_findings(spark: SparkSession, each: int = 250) -> DataFrame:
    """The made, worded and keyed findings (before, candidate, after, label, path)."""
    placeless = made_findings(spark, each).unionAll(keyed_findings(spark, each)).withColumn("path", F.lit(None).cast("string"))
    return placeless.unionByName(worded_findings(spark, each))


def training(spark: SparkSession, words: DataFrame, each: int = 250) -> DataFrame:
    """:func:`all_findings` with the coverage by ``words`` and by ``WORDS``, which any dictionary is taken to hold."""
    found = all_findings(spark, each)
    known = words.unionAll(spark.createDataFrame([(w,) for w in WORDS], "word string"))
    return found.join(covered(found, known), "candidate", "left")


def train(findings: DataFrame, trees: int = 40, depth: int = 8, most_findings: int = 20_000, seed: int = 7) -> PipelineModel:
    """A forest from labelled findings, the first ``most_findings`` of them by content."""
    if "coverage" not in findings.columns:
        findings = findings.withColumn("coverage", F.lit(0.0))
    if "path" not in findings.columns:
        findings = findings.withColumn("path", F.lit(None).cast("string"))
    total = ["before", "candidate", "after", "path", "label", "coverage"]
    bounded = findings.orderBy(F.xxhash64(*total), *total).limit(most_findings)
    rows = cut(features(bounded).coalesce(1))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    model: RandomForestClassificationModel = forest.fit(assembler.transform(rows))
    return PipelineModel([assembler, model])


def score(found: DataFrame, model: PipelineModel, words: DataFrame) -> DataFrame:
    """(id, nth, candidate, before, after, probability) of candidates; half or more means a secret."""
    described = features(found.join(covered(found, words), "candidate", "left"))
    scored = model.transform(described)
    return scored.select("id", "nth", "candidate", "before", "after", F.get(vector_to_array("probability"), F.lit(1)).alias("probability"))


def scan(docs: DataFrame, model: PipelineModel, words: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """:func:`score` of the candidates of ``docs``, which are written down so that texts are matched once."""
    return score(cut(candidates(docs, id_col, text_col, path_col)), model, words)
