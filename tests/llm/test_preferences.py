from collections import defaultdict

from conftest import DATA
from pyspark.sql import functions as F

from lakemodels.llm import preferences as P

SCHEMA = "pair_id long, turn long, role string, text string, part string"


def brute(chosen, rejected):
    sides = []
    for rows in (chosen, rejected):
        turns = defaultdict(lambda: defaultdict(list))
        for pair, turn, role, text, _ in rows:
            if pair is not None:
                turns[pair][P.LAST_TURN if turn is None else turn].append((role or "unknown", text or ""))
        sides.append(turns)
    out = []
    for pair in {*sides[0], *sides[1]}:
        good, bad = sides[0][pair], sides[1][pair]
        apart = [t for t in {*good, *bad} if sorted(good.get(t, [])) != sorted(bad.get(t, []))]
        at = min(apart, default=None)
        for name, turns in (("chosen", good), ("rejected", bad)):
            for turn, said in turns.items():
                before = at is None or turn < at
                for role, text in said:
                    if not before or name == "chosen":
                        header = f"<|{role}|>\n"
                        learned = len(header) if not before and role == "assistant" else None
                        out.append((pair, "prompt" if before else name, None if turn == P.LAST_TURN else turn, role, f"{header}{text}<|end|>\n", learned))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    chosen = [
        (1, 0, "system", "s", ""), (1, 1, "user", "q", ""), (1, 2, "assistant", "good", ""), (1, 3, "user", "more", ""),
        (2, 0, "user", "same", ""), (2, 1, "assistant", "same", ""), (3, 0, "user", "q", ""), (3, 1, "assistant", "a", ""),
        (4, 0, None, None, ""), (4, None, "assistant", "end", ""), (5, 0, "user", "x", ""), (5, 0, "user", "y", ""),
        (None, 0, "user", "lost", ""), (6, 0, "user", "only chosen", ""),
    ]
    rejected = [
        (1, 0, "system", "s", ""), (1, 1, "user", "q", ""), (1, 2, "assistant", "bad", ""), (2, 0, "user", "same", ""),
        (2, 1, "assistant", "same", ""), (3, 0, "user", "q", ""), (4, 0, "unknown", "", ""), (4, None, "assistant", "other", ""),
        (5, 0, "user", "y", ""), (5, 0, "user", "x", ""), (5, 1, "assistant", "z", ""), (7, 0, "user", "only rejected", ""),
    ]
    got = P.paired(spark.createDataFrame(chosen, SCHEMA), spark.createDataFrame(rejected, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(chosen, rejected)
    empty = spark.createDataFrame([], SCHEMA)
    assert P.paired(empty, empty).count() == 0


def test_query_pairs_every_conversation(spark):
    got = P.op4_preferences(spark, DATA)
    conversations = spark.read.parquet(f"{DATA}/conversations.parquet")
    whole = got.where("part <> 'rejected'").groupBy("pair_id").count()
    assert whole.join(conversations.groupBy(F.col("conv_id").alias("pair_id")).agg(F.count("*").alias("n")), "pair_id").where("count <> n").count() == 0
    learned = got.where("trained_from is not null")
    assert learned.where("part = 'prompt' or role <> 'assistant' or substr(rendered, trained_from, 1) <> '\n'").count() == 0
    answered = conversations.where("role = 'assistant'").select("conv_id").distinct().count()
    assert learned.where("part = 'rejected'").select("pair_id").distinct().count() == answered
