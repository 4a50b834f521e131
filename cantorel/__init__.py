"""cantorel: a PySpark-native engine for building, auditing and searching catalogues."""

from pkgutil import extend_path

# parts of the package can reach a Python worker in different archives
__path__ = extend_path(__path__, __name__)
