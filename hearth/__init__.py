"""hearth: Spark-native impact analytics for household clean-energy programmes.

Every public function is a lazy ``DataFrame -> DataFrame`` transformation built
from the DataFrame / SQL API; nothing here collects data to the driver.
"""

__version__ = "0.1.0"
