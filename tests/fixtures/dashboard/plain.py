q = "SELECT * FROM plain_table"
