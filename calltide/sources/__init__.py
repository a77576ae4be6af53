"""Reading and writing: landed pages, time slices, stored layers."""
