"""Between steps the driver's JVM hands back memory that it has freed outside its heap."""

import re

from brackish.llm.common import settle


def test_settle_hands_back_what_the_jvm_has_freed(spark):
    memory, pid = spark._jvm.org.apache.spark.unsafe.Platform, spark._jvm.java.lang.ProcessHandle.current().pid()

    def resident():
        with open(f"/proc/{pid}/smaps_rollup") as f:
            return int(re.search(r"Rss:\s+(\d+)", f.read())[1]) / 1024

    settle(spark)
    blocks = [memory.allocateMemory(100_000) for _ in range(3_000)]
    for b in blocks:
        memory.setMemory(b, 1, 100_000)
    held = resident()
    for b in blocks[:-1]:  # the last one keeps the pool from shrinking by itself
        memory.freeMemory(b)
    settle(spark)
    try:
        assert held - resident() > 200
    finally:
        memory.freeMemory(blocks[-1])
