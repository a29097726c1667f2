"""Operators on voxel tables: columns t, p, c, z, y, x (int) and v."""
