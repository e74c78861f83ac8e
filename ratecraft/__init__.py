"""ratecraft: rating analytics and additive-effect rating models on Spark.

Every operator takes DataFrames plus column names and returns DataFrames;
nothing is collected to the driver on the data path. Operators that write
intermediate tables run jobs when called.
"""

from ratecraft.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
