"""walletyield: wallet ledgers, daily interest rates and payouts on Spark.

Every public function takes and returns DataFrames; nothing is collected
for control flow. See README.md for the module map.
"""

from walletyield.config import Thresholds

__all__ = ["Thresholds"]
__version__ = "0.1.0"
