"""Reading and writing: landing files, lake tables, audit rows, stored pages."""
