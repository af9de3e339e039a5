"""The query of the whole job: what every rule finds is in its result."""

from workload import queries


def test_everything_returns_what_the_tagging_and_english_rules_find(spark, tmp_path):
    turns = {3: "Thronely my garden is green today", 4: "zorn some garden is here", 5: "the green garden is old", 6: "my green garden is here"}
    words = "my thronely some garden is green today here the old"
    chats = [(9, t, "user", x) for t, x in turns.items()]  # no triggers at these places; de_alpha_num takes out the second and fourth words
    spark.createDataFrame(chats, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(39, words, "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("Thronely",)], "text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [r.asDict() for r in queries.clean_everything(spark, str(tmp_path)).collect() if r["dataset"] == "chats"]
    found = {(r["category"], r["turn"], r["reason"]) for r in rows if r.get("category")}
    assert {x for x in found if x[0] in ("confuse", "not_en")} == {("confuse", 3, "Thronely"), ("not_en", 4, "zorn")}
    assert {r["turn"]: r["text"] for r in rows if not r.get("category")} == {5: "the garden old", 6: "my garden here"}
