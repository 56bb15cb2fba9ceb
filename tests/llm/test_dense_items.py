from .test_decontamination import found

CAR = "A car drives 120 km in 3 hours and 80 km in 2 hours"
BENCH = [(1, CAR), (2, "What is 12 km in miles?"), (3, "Define osmosis."), (4, "How 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 and then we go over all the rest")]


def test_items_dense_in_numbers_and_short_items(spark):
    texts = [
        f"It is said: {CAR}, or so.", CAR.replace("80", "81").replace("120", "121").replace("3", "4"), "He asked what is 12 km in miles? Nobody knew.", "What is 13 km in miles?",
        "Well. Define osmosis! It is easy.", "They define osmosis in words.", "define osmosis", "How 9 8 7 and then we go over all the rest",
    ]
    assert set(found(spark, texts, BENCH, run=99)) == {(0, 1), (1, 1), (2, 2), (4, 3), (6, 3)}


def test_every_window_of_an_item_counts(spark):
    got = found(spark, [CAR], BENCH)[0, 1]
    assert got["n_windows"] == got["n_covered"] == 14 - 8 + 1 and not got["changed"]
