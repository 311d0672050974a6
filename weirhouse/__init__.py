"""weirhouse: layered e-commerce analytics as DataFrame functions.

Every operator takes DataFrames and returns DataFrames.  The same function
serves batch tables and, unless its docstring says otherwise, streams.
"""

__version__ = "0.1.0"
