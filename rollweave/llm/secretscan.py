"""Secret scan: candidates from every text, false positives removed by a random forest.

A candidate is a run of ``[A-Za-z0-9+/_-]`` inside a word (a run without white space): every run of at least
``min_length``, and every run of at least ``short_length`` behind an assignment or a key word. The forest
sees its length, changes between kinds of characters, shares of digits and capitals, distinct characters,
how much of it is made of words of the corpus dictionary, whether it stands in a path, address or assignment,
what the document's own path says, and its neighbours. It is trained on labelled findings (doc_id, word_no,
run_no, label), of which a bounded number of each label is used.

The dictionary are the words that a share of all documents holds, so its size is bounded whatever the corpus.
A candidate is cut where its kind of character changes, and its parts are looked up by a join.

Everything runs in DataFrame functions and Spark's own forest; texts are read where they lie, and only
candidates, their parts and counted words are shuffled.

Defined cases: a null or empty text has no candidate; a very long word gives each of its runs, with at most
``AROUND`` characters of the word on either side; repeated rows give repeated findings; a null path says
nothing; without both labels every candidate is kept with score 1; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.session import materialise_stage

MIN_LENGTH = 16
#: Least length behind an assignment or a key word.
SHORT_LENGTH = 8
#: Characters of the candidate's own word kept on either side of it.
AROUND = 64
#: Labelled findings of one label that the forest is fitted on, at most.
SAMPLE = 10_000
#: Share of the documents that hold a word of the dictionary, and their number, at least.
DICTIONARY_SHARE, DICTIONARY_DOCS = 1e-4, 5
TREES, DEPTH = 24, 6

SIGNS = r"A-Za-z0-9+/_\-"
KEY_WORDS = "token|secret|passw|pwd|api|auth|access|credential|private|key"
SAMPLE_WORDS = "example|sample|test|dummy|fake|placeholder|changeme|your|xxx"
#: What stands right before a short candidate: an assignment, or the end of a word with a key word in it.
ASSIGNED = "[=:][\"'`]*$"
INTRODUCED = f"(?i)([=:]|({KEY_WORDS})[a-z]*)[\"'`]*$"
FEATURES = (
    "length transitions digits capitals distinct covered slashes address assigned quoted key_word sample_word sample_path hex".split()
)


def candidates(docs: DataFrame, path: str = "source", min_length: int = MIN_LENGTH, short_length: int = SHORT_LENGTH) -> DataFrame:
    """(doc_id, word_no, run_no, offset, candidate, lead, tail, before, before2, behind, path) of each candidate.

    ``run_no`` counts the runs of a word and ``offset`` its characters before the run; ``lead`` and ``tail``
    are what the word holds around it.
    """
    words = F.split("text", r"[\x20\x09-\x0D]+")
    at = lambda i: F.coalesce(F.get("words", i), F.lit(""))

    def hopeful(i: Column) -> Column:
        word = F.get("words", i)
        short = word.rlike(f"[=:][\"'`]*[{SIGNS}]{{{short_length},}}") | (
            word.rlike(f"^[\"'`]*[{SIGNS}]{{{short_length},}}") & at(i - 1).rlike(INTRODUCED)
        )
        return (F.char_length(word) >= short_length) & (word.rlike(f"[{SIGNS}]{{{min_length},}}") | short)

    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1), hopeful)
    found = F.transform(
        spots,
        lambda i: F.struct(
            i.alias("word_no"), at(i).alias("word"), at(i - 1).alias("before"), at(i - 2).alias("before2"), at(i + 1).alias("behind")
        ),
    )
    rows = (
        docs.where(F.col("text").rlike(f"[{SIGNS}]{{{short_length},}}"))
        .select("doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), words.alias("words"))
        .select("doc_id", "path", F.explode(found).alias("x"))
        .select("doc_id", "path", "x.*")
        # Runs, and what parts them, in turn.
        .withColumn("parts", F.regexp_extract_all("word", F.lit(f"[{SIGNS}]+|[^{SIGNS}]+"), F.lit(0)))
    )

    def wanted(k: Column) -> Column:
        part = F.get("parts", k)
        first = (k == 0) | ((k == 1) & F.get("parts", F.lit(0)).rlike("^[\"'`]+$"))
        introduced = F.coalesce(F.get("parts", k - 1).rlike(ASSIGNED), F.lit(False)) | (first & F.col("before").rlike(INTRODUCED))
        return part.rlike(f"^[{SIGNS}]") & ((F.char_length(part) >= min_length) | ((F.char_length(part) >= short_length) & introduced))

    chosen = F.filter(F.sequence(F.lit(0), F.size("parts") - 1), wanted)
    runs = F.transform(
        chosen,
        lambda k: F.struct(
            # The first part is a run, or the second.
            F.floor((k + F.when(F.get("parts", F.lit(0)).rlike(f"^[{SIGNS}]"), 0).otherwise(-1)) / 2).cast("int").alias("run_no"),
            F.char_length(F.array_join(F.slice("parts", F.lit(1), k), "")).alias("offset"),
            F.get("parts", k).alias("candidate"),
        ),
    )
    each = rows.select("doc_id", "path", "word_no", "word", "before", "before2", "behind", F.explode(runs).alias("r"))
    start, size = F.col("r.offset"), F.char_length("r.candidate")
    lead = F.substr("word", F.greatest(start - AROUND, F.lit(0)) + 1, F.least(start, F.lit(AROUND)))
    return each.select(
        "doc_id", "word_no", "r.run_no", "r.offset", "r.candidate", lead.alias("lead"), F.substr("word", start + size + 1, F.lit(AROUND)).alias("tail"), "before", "before2", "behind", "path"
    )


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE, least: int = DICTIONARY_DOCS) -> DataFrame:
    """(word): words of letters in at least a ``share`` of the documents, and in ``least`` of them."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("\\b([a-z]{3,12})\\b")))
    rows = docs.where("text is not null").count()
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= max(least, share * rows)).select("word")


def _covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """(cid, letters): characters of each candidate under dictionary words; its parts are cut where the kind changes."""
    parts = F.regexp_extract_all("candidate", F.lit("[A-Z]?[a-z]+|[A-Z]+"), F.lit(0))
    cut = found.select("cid", F.explode(parts).alias("part")).select("cid", F.lower("part").alias("word")).where(F.char_length("word") >= 3)
    return cut.join(words, "word").groupBy("cid").agg(F.sum(F.char_length("word")).alias("letters"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES``; ``words`` is the dictionary."""
    own = F.col("candidate")
    n = F.char_length(own).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(own, "[0-9]+", "0"), "[A-Z]+", "A"), "[a-z]+", "a")
    share = lambda signs: F.char_length(F.regexp_replace(own, f"[^{signs}]", "")) / n
    before = F.lower(F.concat_ws(" ", "before2", "before", "lead"))
    around = F.concat("lead", "candidate", "tail")
    flag = lambda c: c.cast("double")
    named = materialise_stage(found.withColumn("cid", F.monotonically_increasing_id()), "candidates")
    return named.join(_covered(named, words), "cid", "left").select(
        *found.columns,
        n.alias("length"),
        (F.char_length(kinds) / n).alias("transitions"),
        share("0-9").alias("digits"),
        share("A-Z").alias("capitals"),
        (F.size(F.array_distinct(F.split(own, ""))) / n).alias("distinct"),
        (F.coalesce("letters", F.lit(0)) / n).alias("covered"),
        (F.char_length(F.regexp_replace(around, "[^/]", ""))).cast("double").alias("slashes"),
        flag(around.rlike("://|@|www\\.|\\.[a-z]{2,4}$")).alias("address"),
        # What stands right before the candidate: quotes and assignment signs.
        flag(F.concat("before", "lead").rlike("[=:]")).alias("assigned"),
        flag(F.concat("lead", "tail").rlike("[\"'`]")).alias("quoted"),
        flag(before.rlike(KEY_WORDS)).alias("key_word"),
        flag(F.lower(F.concat_ws(" ", "before2", "before", around, "behind")).rlike(SAMPLE_WORDS)).alias("sample_word"),
        flag(F.lower("path").rlike("test|example|sample|docs?/|spec")).alias("sample_path"),
        flag(own.rlike("^[0-9a-f]+$|^[0-9A-F]+$")).alias("hex"),
    )


def scan(
    docs: DataFrame, findings, path: str = "source", sample: int = SAMPLE, min_length: int = MIN_LENGTH, short_length: int = SHORT_LENGTH, seed: int = 7
) -> DataFrame:
    """(doc_id, word_no, run_no, offset, candidate, score, is_secret) of every candidate.

    ``findings`` is a table (doc_id, word_no, run_no, label), or a function that makes the label column (null:
    not labelled) from the columns of ``candidates`` and ``features``.
    """
    rows = materialise_stage(features(candidates(docs, path, min_length, short_length), dictionary(docs)), "features")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    key = ["doc_id", "word_no", "run_no"]
    if callable(findings):
        labelled = rows.withColumn("label", findings())
    else:
        labelled = rows.join(findings.select(*key, F.col("label").cast("double").alias("label")), key)
    labelled = labelled.where("label is not null").select("label", "features", F.xxhash64(*key, F.lit(seed)).alias("draw"))
    size = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    out = [*key, "offset", "candidate"]
    if not (size.get(0.0) and size.get(1.0)):
        return rows.select(*out, F.lit(1.0).alias("score"), F.lit(True).alias("is_secret"))
    # A hash threshold takes about ``sample`` of each label without a sort.
    share = F.when(F.col("label") == 1, sample / size[1.0]).otherwise(sample / size[0.0])
    drawn = materialise_stage(
        labelled.where(F.pmod("draw", F.lit(1 << 30)) < share * (1 << 30)).select("label", "features"), "labelled"
    )
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt")
    scored = forest.fit(drawn).transform(rows)
    score = vector_to_array("probability")[1]
    return scored.select(*out, score.alias("score"), (score >= 0.5).alias("is_secret"))


def strict_form() -> Column:
    """The forms of three issuers, in any case of letters."""
    token = F.lower(F.concat_ws(" ", "before2", "before", "lead")).rlike("token")
    password = F.lower("lead").rlike("passw(or)?d[\"'`]?[=:][\"'`]*$") & F.col("candidate").rlike("[0-9]")
    return F.col("candidate").rlike("(?i)^AKIA[0-9A-Z]{16}$") | (F.col("candidate").rlike("(?i)^[0-9a-f]{40}$") & token) | password


def harmless() -> Column:
    """What is no secret for certain: dictionary words, parts of paths and addresses, plain numbers."""
    words = F.col("covered") >= 0.9
    place = (F.col("address") == 1) | ((F.col("slashes") >= 2) & (F.col("covered") >= 0.5))
    number = F.col("candidate").rlike("^[0-9]+([-/][0-9]+)*$")
    return words | place | number


def labelled_by_form(folds: int = 4, held: int = 2) -> Column:
    """Labels for the documents outside the held-out fold: 1 for a strict form, 0 for what is harmless, null for all else.

    The test tables hold no findings that people have labelled; these stand in for them. A form that is
    neither is left unlabelled, so the forest is not taught that unknown secrets are none.
    """
    trained = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held
    return F.when(trained & strict_form(), 1.0).when(trained & harmless(), 0.0)
