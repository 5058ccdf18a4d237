"""Reading what exposure work arrives in: delimited text, workbooks, lists, documents, archives, pictures."""
