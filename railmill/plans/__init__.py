"""Data products: staging, intermediate, core and mart models, and the queries over them."""
