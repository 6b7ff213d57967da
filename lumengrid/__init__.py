"""lumengrid: an analytics library on Spark for multi-camera (5 x 5) light-field captures."""
