"""Reading and writing tables: points, grids, tile fits, products and job logs."""
