import pyarrow as pa
from deedflow.llm import queries, templates
from pyspark.sql import functions as F

ITEM = "Tom has 5 apples and 7 kg of pears. How many apples does Anna give to Tom after 5 days?"
TWIN = "Lisa has 9 apples and 8 kg of pears. How many apples does Bert give to Lisa after 9 days?"
TWISTED = "Tom has 9 apples and 8 kg of pears. How many apples does Anna give to Tom after 4 days?"
BENCH = [(1, ITEM), (2, "Name the largest planet orbiting"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8 9 10 11 12")]


def found(spark, texts, bench=BENCH, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in templates.contaminated(docs, items, **more).collect()}


def test_copies_and_new_parameters(spark):
    got = found(spark, ["Some words before. " + ITEM + " And after.", "before that: " + TWIN, ITEM.upper(), ITEM.replace(" ", "\n\t "), "nothing of the kind is here at all, my friend", None, "", ITEM, ITEM])
    assert {k[0] for k in got} == {0, 1, 2, 3, 7, 8} and {k[1] for k in got} == {1}
    assert not got[0, 1]["changed"] and got[1, 1]["changed"] and got[0, 1]["n_covered"] == got[0, 1]["n_windows"]


def test_slots_must_be_consistent(spark):
    # 5 and 5 of the item would be 9 and 4 in one place
    assert found(spark, [TWISTED], run=99, cover=0.5) == {}
    assert (0, 1) in found(spark, [TWIN], run=99, cover=0.5)


def test_short_items_and_tables(spark):
    assert set(found(spark, ["Please name the largest planet orbiting, he said", "the largest planet"])) == {(0, 2)}
    # a run of numbers is no template
    assert found(spark, ["20 21 22 23 24 25 26 27 28 29 30 31"]) == {}


def test_passage_in_a_very_long_text_and_many_times(spark):
    got = found(spark, ["filler text goes on " * 40000 + ITEM + " more filler " * 10, (ITEM + " ") * 500])
    assert set(got) == {(0, 1), (1, 1)}


def test_empty_sides(spark, none):
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    assert templates.contaminated(none, items).count() == 0
    assert found(spark, [ITEM], BENCH[2:4]) == {}


def test_types_of_tokens():
    row, plain, named, slots = templates.tokens(pa.array(["It costs 5 kg, Anna said. Bob has 3km and €7 or 20%."]))
    words = "It costs 5 kg Anna said Bob has 3km and 7 or 20".split()
    kinds = {v: k for k, v in templates._TYPES.items()}
    assert len(row) == len(words)
    assert [kinds.get(x) for x in named] == [None, None, "number", "unit", "name", None, None, None, "measure", None, "number", None, "measure"]
    assert kinds.get(plain[4]) is None and slots[4] != 0 and slots[0] == 0


def brute(texts, items):
    """Documents that hold half of an item's eight-word windows, by plain words."""
    words = lambda t: [w for w in (x.strip(templates.PUNCTUATION).lower() for x in (t or "").split()) if w]
    cut = lambda w: {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
    bench = {i: cut(words(t)) for i, t in items}
    return {(d, i) for d, t in texts for i, w in bench.items() if w and 2 * len(w & cut(words(t))) >= len(w)}


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_template_decontamination(spark, sf).collect()}
    assert brute(docs, items) <= got and {d for d, _ in got} == {d for d, _ in brute(docs, items)}


def test_odd_rows(odd, spark):
    items = spark.createDataFrame([(1, "Le chat est sur le tapis et le chien dort.")], "item_id long, text string")
    got = templates.contaminated(odd.withColumn("item_id", F.lit("clash")), items).collect()
    assert {r["doc_id"] for r in got} == {None, 5} and len(got) == 2


def test_pieces_of_a_long_text_give_the_windows_of_the_whole():
    text = "| | " * 40 + (TWIN + " Then 7 kg | | more, and Anna Smith said 3 times 4. ") * 40 + " ! " * 90 + ITEM
    pick = lambda got: set(zip(got["pos"].tolist(), got["length"].tolist(), got["hash"].tolist()))
    whole = templates.windows(pa.array([text]), [5, 8], None)
    cut = list(templates._windows_of_pieces(text, [5, 8], None, most=300))
    assert len(cut) > 5 and set().union(*map(pick, cut)) == pick(whole)
    assert sum(len(c["pos"]) for c in cut) == len(whole["pos"])
