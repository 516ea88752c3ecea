"""Operations of a training-data pipeline over tables of documents; nothing else imports this package.

Every operator takes a frame and the names of its id and text column and reads no other column, so
further columns, whatever their names, neither clash nor reach a result.  The common rules: a null
text is an empty text; a null id is one document that comes after all others; rows sharing an id
are one document; an empty table gives an empty result.
"""
