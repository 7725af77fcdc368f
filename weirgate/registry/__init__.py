"""Every operator as a query over the given tables, with the SQL that checks it."""

from weirgate.registry import documents, duplicates, index, stored, urls

QUERIES = {**index.QUERIES, **documents.QUERIES, **duplicates.QUERIES, **urls.QUERIES, **stored.QUERIES}
SQL = {**index.SQL, **documents.SQL, **duplicates.SQL, **urls.SQL, **stored.SQL}
