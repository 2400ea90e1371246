"""What counts as the failure of one table or load among many; anything else is a mistake in the code and ends them all."""

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

from .sources.commits import Conflict

FAILURES = (PySparkException, Py4JError, OSError, ValueError, Conflict)
