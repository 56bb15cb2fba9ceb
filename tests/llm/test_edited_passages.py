from .test_decontamination import found

PASSAGE = (
    "The old mill by the river had 40 workers and stood near Haus for many years until one day the owner sold it to a man from the city who "
    "wanted to build a larger place there, but all the people of the village came to Haus and said that 40 of them would rather stay where they were"
)


def test_one_of_two_values_edited(spark):
    number = PASSAGE.replace("40 of them", "41 of them")
    name = PASSAGE.replace("came to Haus", "came to Hof")
    got = found(spark, [number, name, PASSAGE], [(1, PASSAGE)])
    assert set(got) == {(0, 1), (1, 1), (2, 1)}
    assert got[0, 1]["longest"] >= 30 and not got[2, 1]["changed"] and got[2, 1]["n_covered"] == got[2, 1]["n_windows"]


def test_other_values_still_have_to_be_consistent(spark):
    item = "Then 5 men went up and 5 men went down but all 5 of them came back home"
    assert found(spark, [item.replace("5", "9"), "Then 5 men went up and 6 men went down but all 7 of them came back home"], [(1, item)], run=99, cover=0.6).keys() == {(0, 1)}
