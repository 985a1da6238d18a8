from roadloom.operators import graph as G


def test_chain_of_many_short_segments(spark):
    ids = [f"s{i:02d}" for i in range(40)]
    step = spark.createDataFrame(list(zip(ids, ids[1:])), "src string, dst string")
    lengths = spark.createDataFrame([(i, 2.0) for i in ids], "segment_id string, length double")
    got = [x.dst for x in G.chain(step, lengths, 55.0).where("src = 's00'").orderBy("ord").collect()]
    assert got == ids[1:29]  # 28 segments of 2 m cover 55 m
