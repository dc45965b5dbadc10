from relcheck.operators.messages import sequence_within


def test_sequence_within_matches_row_number(spark):
    # one hot file holding most rows, spread over many range partitions
    data = [("hot", i) for i in range(0, 3000, 3)] + [("a", i) for i in range(5)] + [("b", 7)]
    df = spark.createDataFrame(data, "file_name string, row_no int")
    got = {(r.file_name, r.row_no): r.seq
           for r in sequence_within(df, ["file_name"], "row_no", chunk_size=7).collect()}
    exp = {}
    for f in {d[0] for d in data}:
        for i, (ff, rn) in enumerate(sorted(x for x in data if x[0] == f), start=1):
            exp[(ff, rn)] = i
    assert got == exp
