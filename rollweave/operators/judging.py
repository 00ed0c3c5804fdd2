"""Judge and rubric data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollweave.functions.prompts import DEFAULT_SKILL, JSON_ANSWER, JUDGE_TEMPLATES, JUDGEMENT_TEMPLATES, fill, fill_at_once
from rollweave.functions.text import extract_final_answer
from rollweave.operators.messages import as_column, first_match, let, message
from rollweave.operators.ordering import attach, hash_bucket, md5_key, running

# Price per token by model.
PRICES = (
    ("gpt-4", 0.00003, 0.00006),
    ("gpt-3.5-turbo", 0.0000015, 0.000002),
    ("gpt-4-1106-preview", 0.00001, 0.00003),
    ("gpt-4o", 0.0000025, 0.000001),
    ("gpt-4o-mini", 0.00000015, 0.0000006),
    ("gpt-4o-standard", 0.0000025, 0.000001),
    ("gpt-4.1", 0.000002, 0.000008),
    ("gpt-4.1-standard", 0.000002, 0.000008),
    ("gpt-4.1-mini-standard", 0.0000004, 0.0000016),
    ("o3", 0.00001, 0.00004),
    ("o3-standard", 0.00001, 0.00004),
    ("claude-sonnet", 0.000003, 0.000015),
    ("deepseek-chat", 0.00000007, 0.000001),
    ("deepseek-reasoner", 0.00000014, 0.000002),
    ("claude-3-7-sonnet-20250219", 0.000003, 0.000015),
)


def judge_prompts(df: DataFrame, template: str, query: str, prediction: str, label: str, out: str = "judge_prompt") -> DataFrame:
    """The filled template; only the extracted final answer is judged."""
    text = fill(JUDGE_TEMPLATES[template], output=extract_final_answer(prediction), label=F.col(label), input=F.col(query))
    return df.withColumn(out, text)


def judgement_prompts(df: DataFrame, skill: str, prompt: str, responses: str, out: str = "judgement_prompt") -> DataFrame:
    """The judgement prompt of each row's ``skill``; an unknown skill takes the default one's.

    A skill that scores a single response is asked about the first of ``responses``, the others about the
    first two; a row with too few has no prompt.
    """

    def filled(template: str) -> Column:
        slots = {"response": F.get(responses, F.lit(0)), "response1": F.get(responses, F.lit(0)), "response2": F.get(responses, F.lit(1))}
        return fill_at_once(template, **slots, prompt=F.col(prompt))

    known = [(F.col(skill) == name, filled(template)) for name, template in JUDGEMENT_TEMPLATES.items() if name != DEFAULT_SKILL]
    return df.withColumn(out, first_match(known, filled(JUDGEMENT_TEMPLATES[DEFAULT_SKILL])))


def judge_cost(usage: DataFrame, model: str = "model", prices: DataFrame | None = None) -> DataFrame:
    """I8: tokens times price; namespace and ``-standard`` leave the name, unknown models cost 0.

    The registry's price list is a fixed table, hence its broadcast; a list of the caller's
    (``__name``, ``input``, ``output``) is joined as its size asks for.
    """
    table = prices if prices is not None else F.broadcast(usage.sparkSession.createDataFrame(list(PRICES), "__name string, input double, output double"))
    name = F.replace(F.substring_index(model, "/", -1), F.lit("-standard"), F.lit(""))
    joined = usage.withColumn("__m", name).join(table, F.col("__m") == F.col("__name"), "left")
    cost = F.coalesce("input", F.lit(0.0)) * F.col("prompt_tokens") + F.coalesce("output", F.lit(0.0)) * F.col("completion_tokens")
    return joined.withColumn("cost", cost).drop("__m", "__name", "input", "output")


# --- I7 ------------------------------------------------------------------------------------


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def message_tokens(messages: str | Column) -> Column:
    """Content tokens plus 4 (system) or 3 (other) per message."""
    role = lambda m: F.when(m["role"] == "system", 4).otherwise(3)
    return F.aggregate(as_column(messages), F.lit(0), lambda acc, m: acc + F.size(words(m["content"])) + role(m))


def exceeds_context(messages: str | Column, max_context: int, reserve: int, margin: int = 100) -> Column:
    """Over-limit flag."""
    return message_tokens(messages) + reserve + margin > max_context


def fit_messages(messages: str | Column, max_context: int, reserve: int, margin: int = 100) -> Column:
    """System messages stay, the others follow in order while they fit, the first that does
    not is cut and ends the list; a last user turn gets the JSON answer instruction.

    The room for the others is what the system messages leave, and the running total starts at
    the system tokens once more, as in the original rule.
    """
    messages = as_column(messages)
    is_system = lambda m: m["role"] == "system"
    systems = F.filter(messages, is_system)

    def fitted(system_tokens: Column) -> Column:
        room = F.lit(max_context - reserve - margin) - system_tokens
        start = F.struct(system_tokens.alias("used"), F.lit(False).alias("full"), F.array().cast("array<struct<role:string,content:string>>").alias("out"))

        def step(acc: Column, m: Column) -> Column:
            def place(tokens: Column) -> Column:
                size = F.size(tokens) + 3
                fits = acc["used"] + size <= room
                left = room - acc["used"] - 3
                part = message(m["role"], F.array_join(F.slice(tokens, 1, F.greatest(left, F.lit(0))), " "))
                more = F.when(fits, F.array(message(m["role"], m["content"]))).when(left > 0, F.array(part)).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
                return F.struct(
                    F.when(acc["full"] | ~fits, acc["used"]).otherwise(acc["used"] + size).alias("used"),
                    (acc["full"] | ~fits).alias("full"),
                    F.when(acc["full"], acc["out"]).otherwise(F.concat(acc["out"], more)).alias("out"),
                )

            return let(words(m["content"]), place)

        others = F.aggregate(F.filter(messages, lambda m: ~is_system(m)), start, step, lambda acc: acc["out"])
        return F.when(room <= 0, systems).otherwise(let(F.concat(systems, others), instruct))

    def instruct(kept: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        missing = (last["role"] == "user") & ~last["content"].endswith(JSON_ANSWER)
        asked = message("user", F.concat(last["content"], F.lit("\n" + JSON_ANSWER)))
        return F.when(missing, F.concat(F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))), F.array(asked))).otherwise(kept)

    sums = F.aggregate(systems, F.lit(0), lambda acc, m: acc + F.size(words(m["content"])) + 4)
    return let(sums, fitted)


def fit_slot(text: str | Column, template: str, max_context: int, reserve: int, margin: int = 100, placeholder: str = "{output}") -> Column:
    """I7, template form: one slot cut to the room that the template leaves."""
    text = as_column(text)
    room = max_context - len(template.replace(placeholder, "").split()) - reserve - margin
    if room <= 0:
        return F.when(text.isNotNull(), F.lit(""))
    cut = lambda t: F.when(F.size(t) > room, F.array_join(F.slice(t, 1, room), " ")).otherwise(text)
    return let(words(text), cut)


# --- I9, I10 -------------------------------------------------------------------------------


def rubric_scores(df: DataFrame, response: str) -> DataFrame:
    """Weighted mean of score/2 over the rubrics of a response.

    An empty description weighs nothing, a failed judgement scores 0 with its weight, a zero
    total gives 0.
    """
    weight = F.when(F.length("description") > 0, F.coalesce(F.col("weight"), F.lit(1.0))).otherwise(0.0)
    score = F.when(F.length("description") > 0, F.coalesce(F.col("score") / 2, F.lit(0.0))).otherwise(0.0)
    sums = df.groupBy(response).agg(F.sum(score * weight).alias("__s"), F.sum(F.abs(weight)).alias("__w"))
    return sums.select(response, F.when(F.col("__w") != 0, F.col("__s") / F.col("__w")).otherwise(0.0).alias("score"))


def rubric_fields(ground_truth: str | Column) -> Column:
    """Question and rubrics of a JSON ground truth with their key fallbacks."""
    text = as_column(ground_truth)
    item = "struct<title:string,description:string,rubric_item:string,Ingredient:string,weight:double>"
    rubrics = F.from_json(F.get_json_object(text, "$.rubrics"), f"array<{item}>")
    pick = lambda *names: F.coalesce(*[F.nullif(n, F.lit("")) for n in names])
    unified = F.transform(
        rubrics,
        lambda r: F.struct(
            r["title"].alias("title"),
            F.coalesce(pick(r["description"], r["rubric_item"], r["Ingredient"]), F.lit("")).alias("description"),
            F.coalesce(r["weight"], F.lit(1.0)).alias("weight"),
        ),
    )
    question = pick(F.get_json_object(text, "$.query"), F.get_json_object(text, "$.Question"))
    return F.struct(question.alias("query"), unified.alias("rubrics"))


def rubric_metrics(df: DataFrame) -> DataFrame:
    """Mean and population deviation of score times weight, evolving against the rest."""
    value = F.col("score") * F.col("weight")
    evolving = F.when(F.col("kind") == "evolving", value)
    persistent = F.when(F.coalesce(F.col("kind"), F.lit("")) != "evolving", value)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.agg(
        zero(F.avg(evolving)).alias("avg_evolving_reward"),
        zero(F.stddev_pop(evolving)).alias("std_evolving_reward"),
        zero(F.avg(persistent)).alias("avg_persistent_reward"),
        zero(F.stddev_pop(persistent)).alias("std_persistent_reward"),
    )


def rubric_counts(new: DataFrame, buffer: DataFrame) -> DataFrame:
    """New rubrics per prompt and active rubrics per query."""
    per_new = new.groupBy("query").agg(F.count("*").alias("n")).agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("num_new_rubrics"))
    per_query = buffer.groupBy("query").agg(F.count_if(F.col("state") == "active").alias("n"))
    return per_new.crossJoin(per_query.agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("num_active_rubrics")))


# --- I11-I13: the buffer as a long table ---------------------------------------------------


def init_rubric_buffer(df: DataFrame, order: str, ground_truth: str = "ground_truth") -> DataFrame:
    """Rubrics of the first row per query, as persistent ones.

    The first row is found by a combinable ``min_by``, not by ranking a group.
    """
    parsed = df.select(order, rubric_fields(ground_truth).alias("g")).select(order, "g.query", F.coalesce("g.rubrics", F.array().cast("array<struct<title:string,description:string,weight:double>>")).alias("rubrics"))
    first = parsed.where(F.col("query").isNotNull()).groupBy("query").agg(F.min_by("rubrics", order).alias("rubrics"))
    rows = first.select("query", F.explode("rubrics").alias("r"))
    return rows.select("query", "r.title", "r.description", "r.weight", F.lit("persistent").alias("kind"), F.lit("persistent").alias("state"))


def merge_rubrics(buffer: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """The generated rubrics of the first batch per known query join as active ones.

    ``new`` has (query, order, positive, negative) with arrays of (title, description); weight
    +1 and -1.
    """
    listed = lambda c, w: F.transform(F.coalesce(c, F.array().cast("array<struct<title:string,description:string>>")), lambda r: F.struct(r["title"].alias("title"), r["description"].alias("description"), F.lit(w).alias("weight")))
    usable = new.where(F.col("positive").isNotNull() | F.col("negative").isNotNull())
    both = usable.select("query", order, F.concat(listed("positive", 1.0), listed("negative", -1.0)).alias("rubrics"))
    first = both.groupBy("query").agg(F.min_by("rubrics", order).alias("rubrics"))
    known = first.join(buffer.select("query").distinct(), "query", "left_semi")
    added = known.select("query", F.explode("rubrics").alias("r")).select(
        "query", "r.title", "r.description", "r.weight", F.lit("evolving").alias("kind"), F.lit("active").alias("state")
    )
    return buffer.unionByName(added)


def effective_rubrics(buffer: DataFrame) -> DataFrame:
    """What is scored: persistent and active rubrics with their kind."""
    return buffer.where(F.col("state").isin("persistent", "active"))


def merge_report(buffer: DataFrame, new: DataFrame, samples: int) -> DataFrame:
    """Validity rate, skipped rows and average counts over the rows of a step."""
    valid = F.col("positive").isNotNull() | F.col("negative").isNotNull()
    count = F.greatest(F.size("positive"), F.lit(0)) + F.greatest(F.size("negative"), F.lit(0))
    rates = new.agg(
        F.avg(valid.cast("double")).alias("valid_rate"),
        (F.count_if(~valid) * samples).alias("skipped"),
        F.coalesce(F.avg(F.when(valid, count)), F.lit(0.0)).alias("avg_new_rubrics"),
    )
    active = buffer.groupBy("query").agg(F.count_if(F.col("state") == "active").alias("n"))
    return rates.crossJoin(active.agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_active_rubrics")))


def prune_rubrics(buffer: DataFrame, stats: DataFrame, cap: int) -> DataFrame:
    """Zero-deviation active rubrics and those over the cap become inactive.

    ``stats`` has (query, title, std).  Rubrics without statistics stay.  The rank filter is a
    window group limit, so each task passes on at most ``cap`` rows per query.
    """
    joined = buffer.join(stats.select("query", "title", "std"), ["query", "title"], "left")
    active = F.col("state") == "active"
    live = active & ~F.coalesce(F.col("std") == 0, F.lit(False))
    per_query = joined.groupBy("query").agg(F.count_if(live).alias("__live"))
    rank = Window.partitionBy("query").orderBy(F.desc("std"), "title")
    measured = joined.where(live & F.col("std").isNotNull())
    top = measured.withColumn("__rn", F.row_number().over(rank)).where(F.col("__rn") <= cap).select("query", "title", F.lit(True).alias("__top"))
    marked = attach(joined, per_query, ["query"]).join(top.distinct(), ["query", "title"], "left")
    over = (F.col("__live") > cap) & F.col("std").isNotNull() & F.col("__top").isNull()
    state = F.when(active & (~live | over), F.lit("inactive")).otherwise(F.col("state"))
    return marked.withColumn("state", state).drop("std", "__live", "__top")


# --- I14, I15 ------------------------------------------------------------------------------


def sample_answers(df: DataFrame, key: str, text: str, word_limit: int, within: list[str], seed: int | str = 42) -> DataFrame:
    """Answers in seeded order, at least two, up to the first that breaks the word budget."""
    hashed = df.withColumns({"__h": md5_key(seed, key), "__w": F.size(words(F.col(text)))})
    totals = running(hashed, ["__h", key], hash_bucket(F.col("__h")), within, __rank=F.lit(1), __sum=F.col("__w"))
    broken = (F.col("__rank") > 2) & (F.col("__sum") > word_limit)
    stops = totals.groupBy(*within).agg(F.min(F.when(broken, F.col("__rank"))).alias("__stop"))
    kept = attach(totals, stops, within).where(F.col("__stop").isNull() | (F.col("__rank") < F.col("__stop")))
    return kept.drop("__h", "__w", "__rank", "__sum", "__stop")


def cache_generation(df: DataFrame, path: str, step: int) -> None:
    """Inputs and outputs of a generation step as an appended partition.

    The commit protocol makes each append atomic, and task attempts get unique file names.
    """
    stamped = df.withColumns({"training_step": F.lit(step), "saved_at": F.current_timestamp()})
    stamped.write.partitionBy("training_step").mode("append").json(path)
