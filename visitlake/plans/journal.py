"""The journal of a lake's runs: one row per finished step, so that a run that died goes on behind its last finished step."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.sources.landing import path_exists

SCHEMA = "run_id string, step string, facts string"


class Journal:
    """Finished steps of one run. ``run_id`` names what the run works on, so the same work finds its own steps again."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self._spark, self._folder = spark, f"{path}/{run_id}"
        self.run_id = run_id

    def facts(self, step: str) -> dict | None:
        """What the step left behind when it finished; None if it did not."""
        if not path_exists(self._spark, f"{self._folder}/steps"):
            return None
        rows = self._spark.read.schema(SCHEMA).parquet(f"{self._folder}/steps").filter(F.col("step") == step).limit(1).collect()
        return json.loads(rows[0]["facts"]) if rows else None

    def finish(self, step: str, facts: dict) -> None:
        """The step's one row is written last, by one file's commit: a step is finished or it is not."""
        row = [(self.run_id, step, json.dumps(facts))]
        self._spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self._folder}/steps")

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """Rows that later steps need, stored with the run; written anew if the step is done again."""
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self._folder}/{name}")
        return self.kept(name)

    def kept(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}")

    def forget(self) -> None:
        """Remove what the run kept. Its steps stay, as they say that the work is done."""
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(self._folder)
        system = folder.getFileSystem(self._spark._jsc.hadoopConfiguration())
        for status in system.listStatus(folder) if system.exists(folder) else []:
            if status.getPath().getName() != "steps":
                system.delete(status.getPath(), True)
