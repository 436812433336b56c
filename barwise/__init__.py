"""barwise: daily market-bar analytics as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (use it with
``df.transform``); none of them runs an action. See README.md for the map
from operator ids (S*, P*, G*, I*, V*) to modules.
"""

__version__ = "0.1.0"
