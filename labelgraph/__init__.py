"""labelgraph: ontology-labelled training data preparation and checking on Spark.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``) function on the
public PySpark API, so pipelines chain with ``df.transform(op)``. See README.md for the map
from operator families to modules.
"""

__version__ = "0.1.0"
