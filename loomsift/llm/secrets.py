"""Secret scans with a random forest that removes false positives; DataFrame functions and Spark ML only.

Candidates are all runs of eight or more key characters in a word that have a digit, a long run of capitals or mixed
case, or are a value assigned to a telling name in their word or the words before, so minified JSON, query strings,
connection strings and CSV give each of theirs.
The forest judges each by its length, its character classes and transitions, the share that dictionary words cover,
hints in the path (the row's source), what stands left and right of the run in its word, and the neighbouring words. It
is trained on labelled findings that `labelled_findings` makes by rule: credentials as issuers shape them in assignments,
prose and packed records, and the strings that are taken for them (hashes after "commit", identifiers, card and phone
numbers, placeholders, file names, times, shouted words).

Edge cases: null and empty texts have no findings; a null source is an empty path; texts of any length are read whole;
each occurrence is a finding, so repeated rows repeat theirs; an empty table gives an empty result; extra columns are
ignored; rows with a null doc_id are scanned like others. Redaction joins findings to rows by doc_id and text, so rows
that share or lack a doc_id keep to their own findings; of cores that hold one another the longest is replaced first.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import table

#: Runs of key characters (with the padding of base64 at their end) and what stands between them; together the whole word.
TOKENS = "[A-Za-z0-9+/_-]+(?:={1,2}(?=$|[^A-Za-z0-9+/_=\"'-]))?|[^A-Za-z0-9+/_-]+"

#: Labelled findings made for training, trees and their depth, and the probability from which a candidate is a secret.
FINDINGS, TREES, DEPTH, THRESHOLD = 6000, 24, 9, 0.5

# Hints and dictionary words, matched without regard to case.
SECRET_HINT = "(?i)(api|secret|token|passw|pwd|key|auth|cred|bearer|private|access)"
HARMLESS_HINT = "(?i)(sha|commit|hash|uuid|guid|md5|checksum|digest|revision|etag|order|phone|call|card|isbn|version|build|file|image)"
PATH_HINT = "(?i)(test|spec|example|sample|mock|fixture|demo|docs)"
PREFIX = "^(AKIA|ASIA|ghp_|gho_|glpat-|sk_live_|xoxb-|xoxp-|AIza)"
DICTIONARY = (
    "about access admin after again also and another because before between build change changeme class client code config count data date "
    "default demo dummy example file first from function group have here html http image index insert item john key lorem main message "
    "module name number object order page password path placeholder please product project public release report request response result "
    "sample secret server service session some string table template test text that the their there these this time title token type "
    "update user value version which will with world your xxxx 1234 0000"
).split()
#: A name that tells of a secret, right before its value; and what stands before a login of name and value.
NAMES = "(?:pass\\w{0,16}|pwd|secret|token|key|auth(?:orization|entication)?|cred(?:ential)?s?)"
TELLING = f"(?i){NAMES}[\"']?[=:][\"']?$"
SCHEME, HEADER, LOGIN = "(?i)^(?:bearer|basic|token)$", "(?i)authorization[\"']?[:=][\"']?$", "^(?:-u|--user)$"
COMMON_PAIRS = "th he in er an re nd on en at es st nt ti io le is ou ar as de te ed al or ve it me ra ha".split()


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def features(found: DataFrame) -> tuple[DataFrame, list[str]]:
    """Numeric columns of findings (core, left, right, prev1, prev2, next1, path)."""
    core, size = F.col("core"), F.length("core")
    lower = F.lower(core)
    runs = F.size(F.regexp_extract_all(core, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0)))
    pairs = F.size(F.regexp_extract_all(lower, F.lit(f"(?=({'|'.join(COMMON_PAIRS)}))"), F.lit(1)))
    covered = size - F.length(F.regexp_replace(lower, "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), ""))
    before = F.concat_ws(" ", "prev2", "prev1", "left")
    word = F.concat("left", "core", "right")
    made = {
        "f_length": size.cast("double"),
        "f_digits": _ratio(size - F.length(F.regexp_replace(core, "[0-9]", "")), size),
        "f_upper": _ratio(size - F.length(F.regexp_replace(core, "[A-Z]", "")), size),
        "f_hex": core.rlike("^[0-9a-f]+$").cast("double"),
        "f_base32": core.rlike("^[A-Z2-7]+$|^[A-Z0-9]+$").cast("double"),
        "f_dashes": _ratio(size - F.length(F.regexp_replace(core, "[-_/]", "")), size),
        "f_distinct": _ratio(F.size(F.array_distinct(F.split(core, ""))), size),
        "f_transitions": _ratio(runs - 1, size),
        "f_pairs": _ratio(pairs, size),
        "f_dictionary": _ratio(covered, size),
        "f_repeats": core.rlike("(.)\\1\\1\\1").cast("double"),
        "f_prefix": core.rlike(PREFIX).cast("double"),
        "f_assigned": (F.col("left").rlike("[A-Za-z0-9_.-][\"']?[=:][\"']?$") | F.col("prev1").rlike("[=:]$")).cast("double"),
        "f_quoted": F.concat("left", "right").rlike("[\"']").cast("double"),
        "f_login": (F.endswith("left", F.lit(":")) & F.startswith("right", F.lit("@"))).cast("double"),
        "f_secret_hint": before.rlike(SECRET_HINT).cast("double"),
        "f_harmless_hint": before.rlike(HARMLESS_HINT).cast("double"),
        "f_next_hint": F.col("next1").rlike(HARMLESS_HINT).cast("double"),
        "f_path": F.col("path").rlike(PATH_HINT).cast("double"),
        "f_in_path": word.rlike("://|[.][a-z]{2,4}\\b|/").cast("double"),
    }
    return found.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in made.items()}), list(made)


def _named(left: Column, prev1: Column, prev2: Column) -> Column:
    """Whether a value is assigned to a telling name (in its word, in the word before, or across an equals sign between),
    follows a header of authorisation and its scheme, or is the second part of a login."""
    alone = prev1.rlike("^[=:]$") & F.concat(prev2, F.lit("=")).rlike(TELLING)
    login = prev1.rlike(LOGIN) & left.rlike("^[\"']?[A-Za-z0-9._-]+:$")
    return left.rlike(TELLING) | login | ((left.rlike("^[\"']?$")) & (prev1.rlike(TELLING) | prev1.rlike(SCHEME) & prev2.rlike(HEADER) | alone))


def _suspicious(word: Column, prev1: Column, prev2: Column) -> Column:
    inside = (F.length(word) >= 12) & word.rlike(f"[0-9]|[A-Z]{{16}}|[a-z][A-Z]|(?i){NAMES}[\"']?[=:]")
    return (F.length(word) >= 8) & (inside | prev1.rlike(LOGIN) | _named(F.lit(""), prev1, prev2))


def _runs(words: DataFrame) -> DataFrame:
    """One row for each candidate run of words (word, prev1, prev2, next1 and others): core, and left and right of it in the word.

    The words around count only for runs at that end of the word.
    """
    part = lambda i, k: F.coalesce(F.get(F.col("tokens"), i + k), F.lit(""))
    run = lambda t, i: F.struct(
        t.alias("core"),
        F.concat(part(i, -2), part(i, -1)).alias("left"),
        F.concat(part(i, 1), F.when(part(i, 1) == ".", part(i, 2)).otherwise("")).alias("right"),
        F.when(i <= 3, F.col("prev1")).otherwise("").alias("prev1"),
        F.when(i <= 3, F.col("prev2")).otherwise("").alias("prev2"),
        F.when(i >= F.size("tokens") - 2, F.col("next1")).otherwise("").alias("next1"),
    )
    kept = lambda r: r["core"].rlike("^[A-Za-z0-9+/_-]{8}") & (
        r["core"].rlike("[0-9]|[A-Z]{16}") | (F.length(r["core"]) >= 12) & r["core"].rlike("[a-z][A-Z]") | _named(r["left"], r["prev1"], r["prev2"])
    )
    others = [c for c in words.columns if c not in ("word", "prev1", "prev2", "next1")]
    cut = words.withColumn("tokens", F.regexp_extract_all("word", F.lit(TOKENS), F.lit(0)))
    return cut.select(*others, F.explode(F.filter(F.transform("tokens", run), kept)).alias("r")).select(*others, "r.*")


def candidates(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keys`, word_no, core, its neighbours and path: one row for each candidate of docs (keys, text, source)."""
    narrow = docs.select(*keys, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    # Most texts have no digit, capitals, mixed case or assignment: they are not split at all.
    words = narrow.where(F.col("text").rlike("[0-9]|[A-Z]{16}|[a-z][A-Z]|[=:]\\S{8}|[=:][\"']?\\s"))
    # Exploded, as an array of one: a look at a word's neighbours must not split the text again.
    words = words.select(*keys, "path", F.explode(F.array(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"))).alias("words"))
    near = lambda i, k: F.coalesce(F.get(F.col("words"), i + k), F.lit(""))
    at = words.withColumn("at", F.filter(F.transform("words", lambda w, i: F.when(_suspicious(w, near(i, -1), near(i, -2)), i)), lambda i: i.isNotNull()))
    found = at.where(F.size("at") > 0).select(
        *keys,
        "path",
        F.explode(F.transform("at", lambda i: F.struct(i.cast("long").alias("word_no"), near(i, 0).alias("word"), near(i, -1).alias("prev1"), near(i, -2).alias("prev2"), near(i, 1).alias("next1")))).alias("c"),
    )
    return _runs(found.select(*keys, "path", "c.*"))


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """Findings with label 1.0 (secret) or 0.0, made by rule from hashes of the row number."""
    n = spark.range(rows)
    digest = lambda salt: F.sha2(F.concat_ws(":", F.lit(salt), F.col("id").cast("string")), 256)
    pick = lambda salt, *of: F.get(F.array(*map(F.lit, of)), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(of))).cast("int"))
    # Words of two or three syllables, made by rule.
    syllable = lambda salt: F.concat(pick(salt + "a", *"b c ch d f g gr h l m n p pr qu r s st t tr v w".split()), pick(salt + "b", *"a e i o u ie ou é ei".split()), pick(salt + "c", "", "", "", "n", "r", "s", "l", "nd", "ng"))
    made = lambda salt: F.concat(syllable(salt + "1"), syllable(salt + "2"), F.when(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(2)) == 0, syllable(salt + "3")).otherwise(""))
    basis = {
        "w1": made("w1"),
        "w2": made("w2"),
        "p": syllable("p"),
        "q": F.concat(made("q"), pick("stop", "", "", "", ",", ".")),
        "hexes": digest("hex"),
        "b64": F.regexp_replace(F.base64(F.unhex(digest("b64"))), "[+/=\\s]", ""),
        "b32": F.substring(F.translate(F.upper(F.base64(F.unhex(digest("b32")))), "+/=0189", "QRS2345"), 1, 16),
        "digits": F.translate(digest("hex"), "abcdef", "123456"),
        "name": pick("n", "token", "api_key", "secret", "password", "passwd", "auth_token", "access_key", "private_key", "client_secret", "pwd"),
        "hash_name": pick("h", "commit", "sha1", "md5", "checksum", "revision", "etag", "digest", "uuid", "hash", "build"),
        "size": F.get(F.array(*[F.lit(x) for x in (18, 24, 32, 40, 40, 64)]), F.pmod(F.xxhash64("id", F.lit("s")), F.lit(6)).cast("int")),
    }
    # Exploded, as an array of one, so that nothing is computed anew wherever it is used.
    once = lambda df, **columns: df.select("id", F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_of")).select("id", "_of.*")
    n = once(n, **basis)
    word, word2, plain, plain2, hexes, base64, base32, digits, name, hash_name, size = map(F.col, basis)
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    secret_value = F.when(F.col("id") % 3 == 0, F.substr(base64, F.lit(1), size)).otherwise(F.substr(hexes, F.lit(1), size))
    key_id = F.concat(pick("k", "AKIA", "AKIA", "ASIA"), base32)
    issued = F.concat(pick("g", "ghp_", "sk_live_", "glpat-", "xoxb-", "AIza"), F.substring(base64, 1, 36))
    cased = F.concat(F.initcap(word), F.initcap(word2), F.substring(digits, 1, 3))
    slug = F.concat_ws("-", word, word2, F.substring(digits, 1, 4), word)
    uuid = F.concat_ws("-", *[F.substring(hexes, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    fake = pick("f", "xxxxxxxxxxxxxxxx1", "your_token_here1", "changeme12345678", "placeholder0000", "1234567890123456", "0000000000000000", "example_secret_1", "<your-password-1>")
    letters = F.substr(F.translate(base64, "0123456789", "qWzXkVjQbY"), F.lit(1), size)
    # What people choose themselves: letters and a few digits, no words.
    weak = F.concat(F.substr(F.translate(hexes, "0123456789", "kdjfhgqzxw"), F.lit(1), F.pmod(F.col("id"), F.lit(9)) + 8), F.when(F.col("id") % 3 == 0, F.substring(digits, 1, 3)).otherwise(""))
    grant = pick("gr", "authorization", "credential", "credentials", "auth", "creds", "authentication")
    tail = pick("t", "v", "x1", "page", "lang", "ok")
    junk = pick("j", "", "", "", "###", "%%%", "***", "$$$", "&&&", ",", ".")
    none = F.lit("")
    # (label, word, the word before, the one before that, the word after)
    kinds = [
        (1.0, quote(secret_value), F.lit("="), name, plain),
        (1.0, F.concat(name, pick("eq", "=", ":"), secret_value), plain, plain2, plain),
        (1.0, F.concat(key_id, junk), plain, plain2, plain2),
        (1.0, F.concat(key_id, junk), F.lit("="), name, plain),
        (1.0, F.concat(issued, junk), plain, plain2, plain),
        (1.0, F.concat(quote(secret_value), junk), F.concat(name, F.lit(":")), plain, plain),
        (0.0, F.substr(hexes, F.lit(1), size), hash_name, plain, plain),
        (0.0, F.concat(hash_name, pick("eq", "=", ":"), F.substr(hexes, F.lit(1), size)), plain, plain2, plain),
        (0.0, F.concat(uuid, junk), plain, plain2, plain),
        (0.0, F.concat(F.substring(digits, 1, 16), junk), plain, plain2, plain),
        (0.0, F.concat(F.substring(digits, 1, 12), junk), pick("c", "card", "order", "phone", "the", "isbn"), plain, plain),
        (0.0, F.concat(cased, junk), plain, plain2, plain),
        (0.0, F.concat(slug, junk), plain, plain2, plain),
        (0.0, F.concat(word, F.lit("_"), word2, F.substring(digits, 1, 8), pick("x", ".png", ".html", ".txt", "")), pick("m", "file", "image", "the", "see"), plain, plain),
        (0.0, F.concat(name, F.lit("="), fake), plain, plain2, plain),
        (0.0, quote(fake), F.lit("="), name, plain),
        (0.0, F.concat(F.upper(F.concat(word, word2, word)), pick("y", "!!", "", ".")), F.upper(plain), F.upper(plain2), F.upper(plain)),
        (0.0, F.concat(F.lit("https://example.org/"), word, F.lit("/"), F.substring(digits, 1, 9)), plain, plain2, plain),
        (0.0, F.concat(word, F.substring(digits, 1, 4), F.lit("@mail.example")), plain, plain2, none),
        (1.0, F.concat(pick("e", "admin", "root", "app", "user"), F.lit(":"), F.when(F.col("id") % 2 == 0, weak).otherwise(secret_value)), pick("lg", "-u", "--user"), F.lit("curl"), plain),
        (1.0, F.when(F.col("id") % 2 == 0, weak).otherwise(secret_value), pick("sc", "Bearer", "Basic", "Token"), pick("hd", "Authorization:", "authorization="), plain),
        (1.0, F.concat(quote(weak), junk), pick("eq3", "=", ":"), grant, plain),
        (1.0, F.concat(weak, junk), F.concat(grant, pick("eq3", "=", ":")), plain, plain),
        (1.0, F.concat(grant, pick("eq3", "=", ":"), weak), plain, plain2, plain),
        (0.0, F.concat(made("gw"), junk), F.concat(grant, F.lit(":")), plain, plain),
        (0.0, quote(F.concat(word, pick("en", "ed", "able", "ing"))), pick("eq3", "=", ":"), grant, plain),
        # Several runs in one word.
        (1.0, F.concat(F.lit('{"'), name, F.lit('":"'), secret_value, F.lit('","'), tail, F.lit('":2}')), plain, plain2, plain),
        (1.0, F.concat(pick("u", "", "https://example.org/p?", "/p?a=b&", "a=1;"), name, F.lit("="), secret_value, pick("z", "&", ";", ","), tail, F.lit("=2")), plain, plain2, plain),
        (1.0, F.concat(pick("d", "postgres", "mysql", "amqp", "https"), F.lit("://"), pick("e", "app", "root", "user"), F.lit(":"), F.when(F.col("id") % 2 == 0, letters).otherwise(secret_value), F.lit("@db/"), tail), plain, plain2, plain),
        (1.0, F.concat(pick("i", "", "key=", "id,", '{"id":"'), key_id, pick("z", ";", ",", '","'), name, pick("eq", "=", '":"'), secret_value), plain, plain2, plain),
        (1.0, F.concat(name, pick("eq", "=", ":"), letters, pick("z", "", ",x", "&v=2")), plain, plain2, plain),
        (1.0, quote(letters), F.lit("="), name, plain),
        (1.0, F.concat(F.lit('{"'), name, F.lit('":"'), letters, F.lit('"}')), plain, plain2, plain),
        (1.0, letters, F.concat(name, pick("eq2", "=", ":")), plain, plain),
        (0.0, F.concat(word, word2), F.concat(name, F.lit(":")), plain, plain),
        (0.0, F.concat(F.lit('"'), word, word2, F.lit('"')), F.lit("="), name, plain),
        (0.0, F.concat(F.lit('{"'), hash_name, F.lit('":"'), F.substr(hexes, F.lit(1), size), F.lit('","'), tail, F.lit('":2}')), plain, plain2, plain),
        (0.0, F.concat(pick("u", "", "https://example.org/p?", "/p?a=b&", "a=1;"), hash_name, F.lit("="), F.when(F.col("id") % 2 == 0, uuid).otherwise(F.substr(hexes, F.lit(1), size)), pick("z", "&", ";", ","), tail, F.lit("=2")), plain, plain2, plain),
        (0.0, F.concat(F.lit('{"'), name, F.lit('":"'), fake, F.lit('","id":"'), uuid, F.lit('"}')), plain, plain2, plain),
        (0.0, F.concat(pick("i", "1", "id", "row"), F.lit(","), uuid, F.lit(","), F.substring(digits, 1, 12), F.lit(",x")), plain, plain2, plain),
        (0.0, F.concat(pick("o", "", "time=", "at:"), F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1), F.lit("T1"), F.substring(digits, 5, 1), F.lit(":00:00Z")), plain, plain2, plain),
        (0.0, F.concat(pick("v", "get", "is", "on", "new"), F.initcap(word), F.initcap(word2), pick("a", "", "()", ".run()", "=1", ",")), plain, plain2, plain),
        (0.0, F.concat(pick("l", "src/main/", "./", "app/"), F.initcap(word), F.lit("/"), cased, pick("x2", ".java", ".py", ".ts")), plain, plain2, plain),
    ]
    kind = F.pmod(F.xxhash64("id", F.lit("kind")), F.lit(len(kinds)))
    column = lambda at, cast: F.coalesce(*[F.when(kind == k, row[at] if at else F.lit(row[0])) for k, row in enumerate(kinds)]).cast(cast)
    path = pick("path", "app/main.py", "web/index.html", "feed", "lib/config.yml", "tests/test_login.py", "docs/example.md")
    made = once(n, label=column(0, "double"), word=column(1, "string"), prev1=column(2, "string"), prev2=column(3, "string"), next1=column(4, "string"), path=path)
    return _runs(made.drop("id"))


def train(spark: SparkSession) -> RandomForestClassificationModel:
    made, names = features(labelled_findings(spark))
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(made).select("label", "features").coalesce(2)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="onethird", subsamplingRate=0.8)
    return forest.fit(rows)


@lru_cache(maxsize=1)
def default_model(spark: SparkSession) -> RandomForestClassificationModel:
    """train() once a session: it depends on nothing else."""
    return train(spark)


def scan(docs: DataFrame, model: RandomForestClassificationModel, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keys`, word_no, core, score: the candidates of docs that the forest takes for secrets."""
    found, names = features(candidates(docs, keys))
    scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(found))
    score = vector_to_array("probability")[1]
    return scored.withColumn("score", score).where(F.col("score") >= THRESHOLD).select(*keys, "word_no", "core", "score")


def redacted(docs: DataFrame, model: RandomForestClassificationModel, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret found in a text replaced there, and n_chars (if there is one) brought up to date."""
    names = {c: f"_{k}" for k, c in enumerate(docs.columns)}  # columns of any name pass
    told = docs.toDF(*names.values())
    source = F.col(names["source"]) if "source" in names else F.lit("")
    key = F.xxhash64(F.col(names["text"]).cast("string"))
    plain = told.select(F.col(names["doc_id"]).alias("_doc"), key.alias("_hash"), F.col(names["text"]).alias("text"), source.alias("source"))
    found = scan(plain, model, ("_doc", "_hash"))
    # The secrets of one text: as many as it holds.
    by_doc = found.groupBy("_doc", "_hash").agg(F.sort_array(F.collect_set(F.struct(F.length("core").alias("n"), "core")), asc=False)["core"].alias("_cores"))
    by_doc = by_doc.withColumnsRenamed({"_doc": "_doc2", "_hash": "_hash2"})
    both = told.withColumn("_hash", key).join(by_doc, F.col(names["doc_id"]).eqNullSafe(F.col("_doc2")) & (F.col("_hash") == F.col("_hash2")), "left")
    text = F.col(names["text"])
    clean = F.when(F.col("_cores").isNull(), text).otherwise(F.aggregate("_cores", text, lambda t, core: F.replace(t, core, F.lit(mark))))
    out = both.withColumn(names["text"], clean)
    if "n_chars" in names:
        n = F.col(names["n_chars"])
        out = out.withColumn(names["n_chars"], F.when(F.col("_cores").isNull(), n).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), default_model(spark))
    # A report names the place and a digest, not the secret itself.
    return found.select("doc_id", "word_no", F.length("core").cast("long").alias("length"), F.sha2("core", 256).alias("secret_sha256"), "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return redacted(docs, default_model(spark))
