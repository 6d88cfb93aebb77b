"""Give the executors this package.

Python workers import the operators' modules. Under ``spark-submit --py-files``
or an installed package they can already; a plain driver script calls ``ship``,
which sends the package's sources through Spark's own file server once a session, and
sets how many documents go to a worker at once.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import docroll

_SHIPPED: set[str] = set()
#: Rows of one Arrow batch. A batch is held by the executor and by its Python
#: worker, and rows are whole documents; a session's own setting wins.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(docroll.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="docroll-src-"), "docroll_src.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        if not spark.sparkContext.getConf().contains(_BATCH):
            spark.conf.set(_BATCH, str(BATCH_ROWS))
        _SHIPPED.add(app)
    return spark
