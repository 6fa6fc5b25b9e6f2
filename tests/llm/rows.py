"""Small tables with the cases every operator has to stand: see ``odd``."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves
CLASHING = (
    "uid string, part string, host string, key string, drop string, line string, lines string, "
    "answer string, chunk string, bucket string, score string, class_id string, tokens string, "
    "n_lines string, text_2 string, next string, position string, _drop_lines string, _drop_host string, "
    "_own_hash string, _kept_id string, _kept_hash string, _h string, _words string, _a string, path string"
)


def odd(spark, long_words=20_000):
    """NULL in any column, empty and very long texts, ties, repeated rows, and clashing columns."""
    plain = "One line of words here.\nAnother line of words there.\n\nThe last line ends."
    rows = [
        (1, plain, "en", "a", 10),
        (1, plain, "en", "a", 10),
        (1, "another text of the same id", "fr", None, None),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "   \n \n\t ", "de", "b", 3),
        (None, plain + " more", None, "b", 5),
        (None, None, None, None, None),
        (5, " ".join(f"w{k % 997}x" for k in range(long_words)), "en", "a", 1),
        (6, "z" * long_words, "en", "a", 1),
        (7, "été ÉTÉ 漢字 \U0001f600\U0001f600 naïve", "fr", "c", 1),
        (2**62, plain.upper(), "en", "c", 1),
    ]
    names = [part.split()[0] for part in CLASHING.split(", ")]
    filled = [(*row, *(f"{name}{k % 3}" if k % 4 else None for name in names)) for k, row in enumerate(rows)]
    return spark.createDataFrame(filled, f"{DOCUMENTS}, {CLASHING}")


def no_rows(spark):
    return spark.createDataFrame([], DOCUMENTS)
