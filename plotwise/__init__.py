"""plotwise: repeated field-survey cleaning and analysis on Spark DataFrames.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or a
``Column``) and only builds a lazy plan; nothing is collected to the driver.
"""

__version__ = "0.1.0"
