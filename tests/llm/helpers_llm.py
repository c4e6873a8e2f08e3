"""Tables with every awkward case for the operators of the llm folder."""

LONG = "wordy tale of a long text that goes on and on " * 6000
SCHEMA = ("doc_id long, text string, source string, lang string, row int, part int, key string, shard int, slot long, "
          "score double, predicted int, node string, label int, size int, cell int, g int")


def edge_rows():
    tail = (None, 7, 8, "k", 9, 10, 0.5, 3, "n", 4, 5, 6, 7)
    texts = [
        (1, "One plain text of several words here.\nAnd a second line.", "a"), (2, None, "a"), (3, "", None),
        (4, LONG, "b"), (5, "One plain text of several words here.\nAnd a second line.", None),
        (6, "tie", "b"), (6, "tie", "b"), (None, "a text without an id", "c"), (None, None, None),
        (7, " \n\n\t\n", "é"), (8, "ünï çødé 日本語 🙂\r\nx", "z"),
    ]
    return [(*t, *tail) for t in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
