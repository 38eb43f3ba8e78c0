"""tabulon: survey and profile analytics as parameterised Spark DataFrame operators.

Every operator takes DataFrames plus plain Python parameters and returns a lazy
DataFrame; nothing is collected to the driver except documented one-row
parameters (quantile edges, priors, partition offsets).
"""

__version__ = "0.1.0"
