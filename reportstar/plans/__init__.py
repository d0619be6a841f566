"""The models: staging, keys, dimensions, fact, bridges, views and the queries over them."""
