import random
import unicodedata

from deedflow.functions import unicode
from pyspark.sql import functions as F


def test_latin_letters_are_composed_as_by_the_standard(spark):
    rng = random.Random(9)
    letters = "aeEnoUuszcd xÉẹộñ1,ﬁ😀"
    marks = "̸̧̨̛̣̱̀́̂̃̈̊̌"
    texts = ["".join(rng.choice(letters) + "".join(rng.choices(marks, k=rng.choice([0, 0, 1, 2, 3]))) for _ in range(6)) for _ in range(400)] + ["́x", "", "plain", "Ж́й"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [tuple(r) for r in df.select("t", unicode.composed_latin(F.col("t"))).collect()]
    assert got[-1] == (None, None) and got[-2][1] == "Ж́й"  # other scripts need ``composed``
    for t, composed in got[:-2]:
        assert composed == unicodedata.normalize("NFC", t)
