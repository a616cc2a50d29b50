from corpuskiln.operators import filters


def test_unlabelled_toxic_documents_go(spark):
    schema = "doc_id long, text string, extra string"
    clean = [(i, f"the calm river {i} runs by the green hill and the old mill", "x") for i in range(40)]
    toxic = [(100 + i, f"the calm river {i} you idiot moron runs by the hill", "x") for i in range(10)]
    # unlabelled: toxic ones, also late in a long text, with a null id, and a copy; then clean, empty and null ones
    planted = [(200, "by the river you idiot moron", "x"), (201, "the calm river runs by the hill " * 10 + "moron idiot moron idiot", "x"), (None, "idiot moron", "x"), (202, "by the river you idiot moron", "x")]
    stays = [(300, "the green hill and the old mill", "x"), (301, "", "x"), (302, None, "x"), (None, "the calm river", "x"), (300, "the green hill and the old mill", "x")]
    # a label overrides the score, both ways; a null label doesn't count
    override = [(400, "idiot moron", "x"), (401, "the calm old mill", "x"), (402, "moron idiot", "x")]
    labels = [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(10)] + [(400, 0), (401, 1), (402, None)]
    docs = spark.createDataFrame(clean + toxic + planted + stays + override, schema)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    kept, gone = filters.toxicity_filter(docs, marks), filters.toxicity_filter(docs, marks, invert=True)
    key = lambda rows: sorted(map(repr, rows))
    assert kept.columns == gone.columns == docs.columns
    assert key(map(tuple, kept.collect())) == key(clean + stays + override[:1])
    assert key(map(tuple, gone.collect())) == key(toxic + planted + override[1:])
    # without labels nothing can be judged: all stay
    assert filters.toxicity_filter(docs, marks.limit(0)).count() == docs.count()
