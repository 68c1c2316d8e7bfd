"""Bring this package to workers that cannot import it by themselves."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package as a zip, once an application; not where workers find it through their folder or PYTHONPATH."""
    app = spark.sparkContext.applicationId
    seen = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _sent or ROOT in seen or Path.cwd().resolve() == ROOT:
        return
    path = Path(tempfile.mkdtemp(prefix="maskwright-")) / "maskwright.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((ROOT / "maskwright").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
        if (ROOT / "corpus_pipeline.py").exists():
            z.write(ROOT / "corpus_pipeline.py", "corpus_pipeline.py")
    spark.sparkContext.addPyFile(str(path))
    _sent.add(app)
