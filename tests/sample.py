"""The six sample readings that goldens and stream tests share."""

BASE = 1547718000
# (id, seconds after BASE, temperature) in arrival order.
SAMPLE = [
    ("sensor_1", 199, 35.8),
    ("sensor_1", 122, 35.0),
    ("sensor_1", 198, 39.8),
    ("sensor_6", 201, 15.4),
    ("sensor_7", 202, 6.7),
    ("sensor_10", 205, 38.1),
]
