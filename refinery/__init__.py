"""refinery: DataFrame operators and entity pipelines that refine raw business records.

The package is layered: ``functions`` builds columns, ``operators`` turns frames into
frames, ``sources`` reads and writes, ``plans`` composes them into entity pipelines, and
``streaming`` applies the stateless pipelines to a stream.
"""
