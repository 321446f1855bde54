"""quotelake: a Spark-native market-data lakehouse.

``functions`` are Column helpers, ``operators`` are generic DataFrame
transformations, ``sources`` read and write the lake, ``plans`` are the data
products built from them, ``streaming`` is the file-stream trigger of the same
ingest, and ``catalog`` maps the supplied tables onto the vendor feeds.
"""

from quotelake.session import get_session

__all__ = ["get_session"]
